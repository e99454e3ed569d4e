"""Contract, bronze Parquet, catalog helpers and stream I/O."""

from postlake.sources.bronze import list_signatures, scan_bronze, write_bronze
from postlake.sources.catalog import export_csv, materialize, run_sql
from postlake.sources.contract import Contract, apply_contract, load_contract, posting_contract
from postlake.sources.manifest import compact_manifest, read_manifest, update_manifest
from postlake.sources.stream_io import decode_value, keyed_records, read_stream, write_keyed

__all__ = [
    "list_signatures", "compact_manifest", "read_manifest", "update_manifest", "scan_bronze", "write_bronze", "export_csv", "materialize", "run_sql",
    "Contract", "apply_contract", "load_contract", "posting_contract", "decode_value",
    "keyed_records", "read_stream", "write_keyed",
]

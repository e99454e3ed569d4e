import base64
import glob
import hashlib
import io

import duckdb
import pytest
import zstandard

from postlake.llm import queries, warc

SCHEMA = "page_id long, url string, html string, record_type string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(a, b, c, "clash", "clash") for a, b, c in rows], SCHEMA)


ROWS = [(5, "http://a/ä\r\nX: y", "same"), (3, "http://b/%41", "same"), (9, None, "same"), (4, "u", None), (7, "u", ""), (None, "u", "same"),
        (1, "u", "long " * 200_000), (8, "u", "ünï\r\n\r\ncode"), (8, "u", "ünï\r\n\r\ncode")]


def read(spark, rows, path, **how):
    warc.write_archive(pages(spark, rows).repartition(3), path, **how)
    return {(r.record_key, r.record_type): r for r in warc.read_archive(spark, path).collect()}, warc.read_archive(spark, path).count()


def test_round_trip(spark, tmp_dir):
    got, n = read(spark, ROWS, tmp_dir + "/w", frame_bytes=1000)
    assert n == len(ROWS)
    kinds = {k: t for k, t in got}
    assert kinds == {"5": "revisit", "3": "response", "9": "revisit", "4": "response", "7": "revisit", None: "revisit", "1": "response", "8": "response"}
    for key, url, html in ROWS:
        r = got[(None if key is None else str(key), kinds[None if key is None else str(key)])]
        data = (html or "").encode()
        assert (r.uri, r.payload_bytes) == (url, len(data))
        assert r.payload_digest == base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert (None if r.payload is None else bytes(r.payload)) == (data if r.record_type == "response" else None)
        assert r.refers_to == (None if r.record_type == "response" else "3" if html == "same" else "4")


def test_smaller_payloads_are_all_responses(spark, tmp_dir):
    got, _ = read(spark, ROWS, tmp_dir + "/w", min_bytes=5)
    assert all(t == "response" for _, t in got)


def test_files_are_zstandard_with_a_seek_table(spark, tmp_dir):
    read(spark, ROWS, tmp_dir + "/w", frame_bytes=500)
    for name in glob.glob(tmp_dir + "/w/part-*"):
        data = open(name, "rb").read()
        whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
        table = warc.seek_table(data)
        assert sum(plain for _, _, plain in table) == len(whole)
        for key, frame, offset, length in warc.record_map(data, table):
            before = sum(plain for _, _, plain in table[:frame])
            assert whole[before + offset:before + offset + length].startswith(b"WARC/1.1\r\n")


def test_lookup_by_key(spark, tmp_dir):
    warc.write_archive(pages(spark, ROWS), tmp_dir + "/w")
    rows = warc.read_archive(spark, tmp_dir + "/w", keys=["1", "4"]).collect()
    assert sorted(r.record_key for r in rows) == ["1", "4"]


def test_bundles_are_cut_and_damage_is_seen(spark, tmp_dir):
    rows = [(i, "u", hashlib.sha512(str(i).encode()).hexdigest() * 20) for i in range(400)]
    warc.write_archive(pages(spark, rows).repartition(1), tmp_dir + "/w", frame_bytes=4000, bundle_bytes=20_000)
    assert len(glob.glob(tmp_dir + "/w/part-*")) > 3
    assert warc.read_archive(spark, tmp_dir + "/w").count() == 400
    with pytest.raises(ValueError):
        warc.seek_table(b"no footer here")


def test_empty_table(spark, tmp_dir):
    warc.write_archive(pages(spark, ROWS).limit(0), tmp_dir + "/w")
    assert warc.read_archive(spark, tmp_dir + "/w").collect() == []


def test_query_matches_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"create view pages as select * from read_parquet('{sf}/pages.parquet')")
    cols = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    want = con.execute(f"select {','.join(cols)} from ({queries.WARC_SQL}) order by page_id").fetchall()
    got = queries.op1_warc(spark, sf)
    assert [tuple(r) for r in got.select(*cols).orderBy("page_id").collect()] == want
    assert dict(got.dtypes)["payload_bytes"] == "bigint"

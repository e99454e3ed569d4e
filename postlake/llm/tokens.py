"""Token-ID files: word-aligned Simple-8b coding of public tokenizers' ids, with offsets per block.

A file holds the ids of whole documents in order. Ids are cut into blocks of ``BLOCK`` (the last one is shorter); each
block is a run of 64-bit little-endian words. A word's top four bits are its selector: how many ids of how many bits
the other 60 bits hold, lowest bits first. Selector 15 is an escape: one id of up to 60 bits. Offsets of blocks let a
reader decode any block alone, and all words of a selector at once. Layout: words, then the index (a JSON header's
arrays as raw integers), then the index's length and the magic number.
"""

from __future__ import annotations

import json
import os
import struct
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, prepare, read_blobs, running_sum, scratch_path, slices, text_bytes, tidied, write_blobs

# Fixed values of the Simple-8b layout: ids in a word and bits of each, by selector. Runs of 240 and 120 zeros come first.
COUNTS = np.array([240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
BITS = np.array([0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
MAGIC = b"S8bTOKN1"
BLOCK = 1024
FILE_IDS = 2_000_000
END_ID = 2


def _pack_blocks(grid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of a grid of ids, a block in each row, and the number of words of each block.

    Every position learns the selector of the most ids that one word can hold from there; then all blocks step through
    their words together, and all words of a selector are filled at once.
    """
    blocks, block = grid.shape
    # bits of each id (an id of over 53 bits may count as one bit longer and then takes the escape)
    width = np.frexp(grid.astype(np.float64))[1].astype(np.uint8)
    fits = np.full(grid.shape, len(COUNTS) - 1, np.uint8)
    for s in range(len(COUNTS) - 2, -1, -1):
        c = int(COUNTS[s])
        if c > block:
            continue
        free = width <= BITS[s]
        if int(free.sum()) < c:
            continue
        run = 1
        while run < c:  # free[i]: the ids i to i + run - 1 fit
            step = min(run, c - run)
            free = free[:, :free.shape[1] - step] & free[:, step:]
            run += step
        np.copyto(fits[:, :block - c + 1], np.uint8(s), where=free)
    fits, flat = fits.ravel(), grid.ravel()
    first = np.arange(blocks) * block
    at, row = first.copy(), np.arange(blocks)
    rows, places, selectors = [], [], []
    taken = np.zeros(blocks, np.int64)
    while len(row):
        s = fits[at]
        rows.append(row)
        places.append(at)
        selectors.append(s)
        taken[row] += 1
        at = at + COUNTS[s]
        inside = at < first[row] + block
        if not inside.all():
            at, row = at[inside], row[inside]
    starts = np.cumsum(taken) - taken
    order = np.concatenate([starts[r] + turn for turn, r in enumerate(rows)])
    place, select = np.concatenate(places), np.concatenate(selectors)
    value = select.astype(np.uint64) << np.uint64(60)
    for s in np.unique(select):
        count, bits = int(COUNTS[s]), int(BITS[s])
        if bits:
            r = np.nonzero(select == s)[0]
            own, begin = value[r], place[r]
            for k in range(count):
                own |= flat[begin + k] << np.uint64(bits * k)
            value[r] = own
    out = np.empty(len(value), np.uint64)
    out[order] = value
    return out, taken


def pack(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Words (uint64) of ids below 2**60, and the first word of each block, with the total at the end."""
    ids = np.ascontiguousarray(ids, np.uint64)
    whole, some = len(ids) - len(ids) % block, 256 * block  # a few blocks at a time stay in the cache
    grids = [ids[lo:min(lo + some, whole)].reshape(-1, block) for lo in range(0, whole, some)] + [ids[whole:].reshape(1, -1)]
    parts = [_pack_blocks(g) for g in grids if g.size]
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate([w for w, _ in parts]), np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in parts]))])


def unpack(words: np.ndarray) -> np.ndarray:
    """The ids (uint64) of whole words; all words of a selector are decoded at once."""
    select = (words >> np.uint64(60)).astype(np.int64)
    counts = COUNTS[select]
    first = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    body = words & np.uint64((1 << 60) - 1)
    for s in np.unique(select):
        count, bits = int(COUNTS[s]), int(BITS[s])
        if bits:
            r = np.nonzero(select == s)[0]
            shifted = body[r][:, None] >> (np.uint64(bits) * np.arange(count, dtype=np.uint64))
            out[first[r][:, None] + np.arange(count)] = shifted & np.uint64((1 << bits) - 1)
    return out


def file_bytes(doc_ids: list, lengths: np.ndarray, ids: np.ndarray, block: int = BLOCK) -> bytes:
    """One file (but for the magic number): words, index, length of the index."""
    words, starts = pack(ids, block)
    head = json.dumps({"block": block, "ids": int(len(ids)), "docs": len(doc_ids), "null_docs": [i for i, d in enumerate(doc_ids) if d is None]}).encode()
    index = struct.pack("<I", len(head)) + head + np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes() \
        + np.asarray(lengths, "<i8").tobytes() + starts.astype("<i8").tobytes()
    return words.astype("<u8").tobytes() + index + struct.pack("<Q", len(index))


class TokenFile:
    """Reader of one file's bytes."""

    def __init__(self, data: bytes):
        if data[-len(MAGIC):] != MAGIC:
            raise ValueError("not a token file, or cut off")
        end = len(data) - len(MAGIC) - 8
        size = struct.unpack("<Q", data[end:end + 8])[0]
        index = data[end - size:end]
        n = struct.unpack("<I", index[:4])[0]
        head, at = json.loads(index[4:4 + n]), 4 + n
        self.block, self.n_ids, docs = head["block"], head["ids"], head["docs"]
        numbers = np.frombuffer(index[at:], "<i8")
        null = set(head["null_docs"])
        self.doc_ids = [None if i in null else int(d) for i, d in enumerate(numbers[:docs])]
        self.lengths, self.starts = numbers[docs:2 * docs], numbers[2 * docs:]
        self.words = np.frombuffer(data[:end - size], "<u8")

    def ids(self, lo: int, hi: int) -> np.ndarray:
        """The ids from ``lo`` to ``hi``, from the blocks that hold them."""
        a, b = lo // self.block, -(-hi // self.block)
        if hi <= lo:
            return np.zeros(0, np.uint64)
        return unpack(self.words[self.starts[a]:self.starts[b]])[lo - a * self.block:hi - a * self.block]


#: Encoders by tokenizer file, kept by a Python worker over its tasks. An encoder forgets its words when they, their ids
#: and what finds them take more bytes than this; longer words are encoded each time they come.
_KNOWN: dict[str, WordEncoder] = {}
KEPT_BYTES = 40 << 20
KEPT_LENGTH = 64
#: Bytes of text that are encoded at a time.
SLICE_BYTES = 3 << 20
#: Words that are encoded in one call.
_TOGETHER = 256
#: Fixed odd numbers, one for each place in a word, that make the words' hashes.
_PLACES = np.random.Generator(np.random.PCG64(8)).integers(0, 2 ** 63, KEPT_LENGTH, np.uint64) * np.uint64(2) + np.uint64(1)
#: A letter or digit, and ASCII punctuation (no apostrophe) behind it.
_JOINT = r"([A-Za-z0-9])([!-&(-/:-@\[-`{-~])"


def _gather(flat: np.ndarray, ends: np.ndarray, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The picked runs of ``flat`` one after the other, and their lengths."""
    begin = ends[pick]
    sizes = ends[pick + 1] - begin
    stop = np.cumsum(sizes)
    total = int(stop[-1]) if len(stop) else 0
    small = np.int32 if total + len(flat) < 2 ** 31 else np.int64
    at = np.arange(total, dtype=small)
    at += np.repeat((begin - (stop - sizes)).astype(small), sizes)
    return flat[at], sizes


def word_hashes(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of up to KEPT_LENGTH bytes, from its bytes and length (others: any number)."""
    size = np.diff(off)
    place = np.arange(len(raw)) - np.repeat(off[:-1], size)
    mixed = (raw.astype(np.uint64) + np.uint64(1)) * _PLACES[np.minimum(place, KEPT_LENGTH - 1)]
    out = np.zeros(len(size), np.uint64)
    some = size > 0
    if some.any():
        out[some] = np.add.reduceat(mixed, off[:-1][some])
    out ^= out >> np.uint64(31)
    return out * _PLACES[0] ^ size.astype(np.uint64)


class WordEncoder:
    """Encodes texts word by word (words end at ASCII white space) and remembers words.

    Right for tokenizers whose result for a text is that of its white-space separated words, one after the other, as
    with ``word_bpe_49k.json``: its normalizer composes, lower-cases and joins white space, and its pre-tokenizer never
    reaches across white space. It also parts punctuation (but for apostrophes) from a letter or digit before it, so a
    space is put there, and ASCII texts are lower-cased, which leaves fewer different words. Texts with a special
    token's opening characters are left as they are, and words with them are encoded alone.
    """

    def __init__(self, path: str, special: str = "<|"):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer, self.special = Tokenizer.from_file(path), special
        self.forget()

    def forget(self) -> None:
        # word n is data[begin[n]:begin[n + 1]] and has the ids flat[ends[n]:ends[n + 1]]; word 0 is empty
        self.data, self.begin = np.zeros(0, np.uint8), np.zeros(2, np.int64)
        self.flat, self.ends = np.zeros(0, np.uint32), np.zeros(2, np.int64)
        self.hash, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)  # sorted by hash, no hash twice

    def bytes_kept(self) -> int:
        return sum(x.nbytes for x in (self.data, self.begin, self.flat, self.ends, self.hash, self.number))

    def tokenize(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and the number of ids of each."""
        alone = [i for i, w in enumerate(words) if self.special in w]
        single = set(alone)
        together = [i for i in range(len(words)) if i not in single] if alone else list(range(len(words)))
        groups = [[i] for i in alone] + [together[k:k + _TOGETHER] for k in range(0, len(together), _TOGETHER)]
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for group, e in zip(groups, self.tokenizer.encode_batch([" ".join([words[i] for i in g]) for g in groups], add_special_tokens=False)):
            own = np.array(e.ids, np.uint32)
            begin = np.cumsum([len(words[i]) + 1 for i in group[:-1]], dtype=np.int64)
            cut = np.searchsorted(np.fromiter((a for a, _ in e.offsets), np.int64, len(own)), begin)
            ids.append(own)
            sizes.append(np.diff(np.concatenate([[0], cut, [len(own)]])))
        flat, size = np.concatenate(ids), np.concatenate(sizes)
        if alone:
            flat, size = _gather(flat, np.concatenate([[0], np.cumsum(size)]), np.argsort(np.array(alone + together), kind="stable"))
        return flat, size

    def _find(self, raw: np.ndarray, off: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each word (-1: not known), and whether a word of the same hash is known."""
        size, number = np.diff(off), np.full(len(hashes), -1, np.int64)
        number[size == 0] = 0
        at = np.minimum(np.searchsorted(self.hash, hashes), max(0, len(self.hash) - 1))
        same = (self.hash[at] == hashes) & (size > 0) if len(self.hash) else np.zeros(len(hashes), bool)
        maybe = np.nonzero(same & (size <= KEPT_LENGTH))[0]
        n = self.number[at[maybe]].astype(np.int64) if len(maybe) else np.zeros(0, np.int64)
        alike = self.begin[n + 1] - self.begin[n] == size[maybe]
        maybe, n = maybe[alike], n[alike]
        own, sizes = _gather(raw, off, maybe)
        other, _ = _gather(self.data, self.begin, n)
        if len(maybe):
            differ = np.add.reduceat(own != other, np.cumsum(sizes) - sizes, dtype=np.int64) > 0
            number[maybe[~differ]] = n[~differ]
        return number, same

    def _keep(self, raw, off, hashes, pick, flat, ends) -> None:
        """Remember the picked words, whose ids are flat[ends[k]:ends[k + 1]] in turn; of words of one hash only one."""
        _, first = np.unique(hashes[pick], return_index=True)
        own, sizes = _gather(raw, off, pick[first])
        ids, counts = _gather(flat, ends, first)
        known = len(self.begin) - 1
        self.data, self.flat = np.concatenate([self.data, own]), np.concatenate([self.flat, ids])
        self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum(sizes)])
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(counts)])
        every = np.concatenate([self.hash, hashes[pick][first]])
        number = np.concatenate([self.number, np.arange(known, known + len(first), dtype=np.int32)])
        order = np.argsort(every, kind="stable")
        self.hash, self.number = every[order], number[order]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and the number of ids of each (null: 0)."""
        texts = texts.cast(pa.large_string()).fill_null("")
        apart = pc.replace_substring_regex(texts, _JOINT, r"\1 \2")
        apart = pc.if_else(pc.string_is_ascii(texts), pc.ascii_lower(apart), apart)
        lists = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, self.special), texts, apart))
        coded = lists.flatten().dictionary_encode()
        if self.bytes_kept() > KEPT_BYTES:
            self.forget()
        raw, off = text_bytes(coded.dictionary)
        hashes = word_hashes(raw, off)
        number, taken = self._find(raw, off, hashes)
        new = np.nonzero(number < 0)[0]
        fresh, counts = self.tokenize(coded.dictionary.take(pa.array(new)).to_pylist())
        fresh_ends = np.concatenate([[0], np.cumsum(counts)])
        number[new] = len(self.ends) - 1 + np.arange(len(new))
        flat, ends = np.concatenate([self.flat, fresh]), np.concatenate([self.ends, self.ends[-1] + fresh_ends[1:]])
        ids, sizes = _gather(flat, ends, number[coded.indices.to_numpy(zero_copy_only=False)])
        keep = np.nonzero((np.diff(off)[new] <= KEPT_LENGTH) & ~taken[new])[0]
        own, _ = _gather(fresh, fresh_ends, keep)
        self._keep(raw, off, hashes, new[keep], own, np.concatenate([[0], np.cumsum(counts[keep])]))
        bounds = np.asarray(lists.offsets, np.int64)
        return ids, np.diff(np.concatenate([[0], np.cumsum(sizes)])[bounds - bounds[0]])


def word_encoder(path: str) -> WordEncoder:
    if path not in _KNOWN:
        _KNOWN[path] = WordEncoder(path)
    return _KNOWN[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, block: int = BLOCK, file_ids: int = FILE_IDS, step: int = 2000) -> None:
    """Encode every whole text (null: empty), append ``end_id``, and write the ids in ascending ``id_col`` order.

    Null ids come last. Documents of equal id come in the order of their texts' hashes (xxhash64), so that an id, or a
    row, that repeats through the table is dealt to many tasks. A task writes files of about ``file_ids`` ids, looking
    at least every ``step`` documents; a document is never cut. An empty table writes no file. ``tokenizer``: path of a tokenizers file.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"),
                       F.xxhash64(F.col(text_col).cast("string")).alias("hash"), F.monotonically_increasing_id().alias("turn"))

    def encode(batches):
        encoder = word_encoder(tokenizer)
        docs_held, lengths, ids, held = [], [], [], 0

        def done():
            data = file_bytes(docs_held, np.concatenate(lengths), np.concatenate(ids), block)
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["file"])

        for b in tidied(batches):
            for lo, hi in slices(b.column(1), SLICE_BYTES, step):
                part = b.slice(lo, hi - lo)
                own, sizes = encoder.encode(part.column(1))
                ends = np.cumsum(sizes)
                ids.append(np.insert(own, ends, np.uint32(end_id)))
                lengths.append(sizes + 1)
                docs_held += part.column(0).to_pylist()
                held += len(ids[-1])
                if held >= file_ids:
                    yield done()
                    docs_held, lengths, ids, held = [], [], [], 0
        if docs_held:
            yield done()

    order = [F.col("id").asc_nulls_last(), "hash", "turn"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "text")
    write_blobs(ordered.mapInArrow(encode, "file binary"), "file", path, MAGIC)


def read_tokens(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document of the files below ``path``: id, start, n_tokens, ids_crc32 (of the ids as little-endian uint32).

    Files are in the order of their first document, which is that of the ids over all files. Start positions come from
    running sums over files, shifted within each.
    """
    prepare(spark)

    def read(batches):
        for b in tidied(batches):
            for name, data in zip(b.column(0).to_pylist(), b.column(1)):
                f = TokenFile(data.as_py())
                ids = f.ids(0, f.n_ids).astype("<u4")
                ends = np.cumsum(f.lengths)
                crc = [zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends, f.lengths)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(ends), pa.string()), pa.array(f.doc_ids, pa.int64()), pa.array(ends - f.lengths),
                     pa.array(f.lengths), pa.array(crc, pa.int64()), pa.array(np.full(len(ends), f.n_ids, np.int64))],
                    names=["file", "id", "at", "n_tokens", "ids_crc32", "file_ids"])

    schema = "file string, id long, at long, n_tokens long, ids_crc32 long, file_ids long"
    docs = materialize(read_blobs(spark, path).mapInArrow(read, schema), "token-docs")
    files = docs.where("at = 0").select("file", "file_ids")
    # names sort by task and then by file of the task, as the writer made them
    order = F.regexp_extract("file", r"part-(\d+)-.*-c(\d+)", 1).cast("long"), F.regexp_extract("file", r"part-(\d+)-.*-c(\d+)", 2).cast("long")
    files = running_sum(files.withColumn("task", order[0]).withColumn("turn", order[1]), ["task", "turn"], {"before": "file_ids"}, "token-files")
    return docs.join(files.select("file", "before"), "file").select(
        F.col("id").alias(id_col), (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer: str, path: str | None = None, id_col: str = "doc_id", **how) -> DataFrame:
    """Write token files (below ``path``, or a scratch folder) and read them back: see the two functions above."""
    path = path or scratch_path(docs.sparkSession, "token-files")
    write_tokens(docs, path, tokenizer, id_col=id_col, **how)
    return read_tokens(docs.sparkSession, path, id_col)

import glob
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from helpers import documents
from postlake.llm import queries, tokens

SF = "/root/testdata/sf0.001"
PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 1), st.integers(0, 50_000), st.integers(0, 2 ** 60 - 1)), max_size=300), st.sampled_from([4, 64, 1024]))
def test_pack_round_trip(ids, block):
    ids = np.array(ids, np.uint64)
    words, starts = tokens.pack(ids, block)
    assert (tokens.unpack(words) == ids).all()
    for k in range(len(starts) - 1):
        assert (tokens.unpack(words[starts[k]:starts[k + 1]]) == ids[k * block:(k + 1) * block]).all()


def test_pack_is_dense():
    assert len(tokens.pack(np.zeros(1024, np.uint64))[0]) <= 1 + 1024 // 120
    assert len(tokens.pack(np.full(1024, 40_000, np.uint64))[0]) == 342
    word = int(tokens.pack(np.array([1, 2, 3], np.uint64))[0][0])
    assert word >> 60 == 13 and [word >> s & (2 ** 20 - 1) for s in (0, 20, 40)] == [1, 2, 3]


TEXTS = ["Hello wORld <|endoftext|> x", "", "a<|startoftext|>b  c d́ \x0b é é  x y", None, "it's 12 don't 'S", " \n",
         "A1.5-b_c (x)[y]{z} don't'S \"q\"'s 3.14,15 a.'s .'s e\u0301. =\u0338 a=\u0338 H\u0331 h\u0331! END.", "H\u0331 H\u0331.", "ABC <|ENDOFTEXT|>, <|endoftext|>.", "\u212a\u017f. x\u00a0y",
         "İΣ 한국어 \U0001f600‍", "word " * 3000, "x" * 20_000, "́ ́a", "<|startoftext|>", "a\x00b\x1fc"]


def test_words_encode_as_whole_texts(library):
    encoder = tokens.WordEncoder(PATH)
    for _ in range(2):
        ids, sizes = encoder.encode(pa.array(TEXTS, pa.string()))
        want = [library(t) for t in TEXTS]
        assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    assert encoder.encode(pa.array([], pa.string()))[0].tolist() == []
    some = pa.array(TEXTS, pa.string()).slice(4, 3)
    assert encoder.encode(some)[0].tolist() == sum([library(t) for t in TEXTS[4:7]], [])


def test_forgetting_words(library, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT_BYTES", 200)
    encoder = tokens.WordEncoder(PATH)
    for t in TEXTS * 2:
        assert encoder.encode(pa.array([t], pa.string()))[0].tolist() == library(t)


def text_hash(text):
    """xxhash64 as a signed long (null: the seed)."""
    n = 42 if text is None else xxhash.xxh64_intdigest(text.encode(), 42)
    return n - (n >> 63 << 64)


def test_table_of_words(library, monkeypatch):
    """Words are told apart by their bytes: one hash for all of them changes nothing."""
    encoder = tokens.WordEncoder(PATH)
    monkeypatch.setattr(tokens, "word_hashes", lambda raw, off: np.full(len(off) - 1, 7, np.uint64))
    for t in TEXTS * 2:
        assert encoder.encode(pa.array([t, "Hello", t], pa.string()))[0].tolist() == library(t) + library("Hello") + library(t)
    assert len(encoder.hash) == 1


def test_kept_bytes_are_bounded(library):
    encoder = tokens.WordEncoder(PATH)
    encoder.encode(pa.array([" ".join(f"w{i}x" for i in range(50_000)), "y" * 100_000], pa.string()))
    assert len(encoder.begin) == 50_002 and encoder.bytes_kept() < 70 * 50_000


def want_rows(rows, library):
    out, start = [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, text_hash(r[1]))):
        ids = library(t) + [2]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_files(spark, tmp_dir, library):
    rows = [(100 - i, t) for i, t in enumerate(TEXTS)] + [(7, "same"), (7, "same"), (None, "no id"), (-5, "below zero")]
    docs = documents(spark, rows, {"start": 1, "id": "clash", "file": "x"}).repartition(4)
    got = tokens.encode_documents(docs, PATH, tmp_dir + "/t", file_ids=20, step=3)
    assert [tuple(r) for r in got.orderBy("start").collect()] == want_rows(rows, library)
    files = glob.glob(tmp_dir + "/t/part-*")
    assert len(files) > 3
    f = tokens.TokenFile(max((open(x, "rb").read() for x in files), key=len))
    everything = f.ids(0, f.n_ids)
    for lo, hi in ((0, 1), (1000, 1030), (1023, 1025), (5, 5), (f.n_ids - 3, f.n_ids)):
        assert (f.ids(lo, hi) == everything[lo:hi]).all()
    with pytest.raises(ValueError):
        tokens.TokenFile(open(files[0], "rb").read()[:-1])


def test_empty_table(spark):
    assert tokens.encode_documents(documents(spark, []), PATH).collect() == []


def test_query(spark, library):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(SF + "/documents.parquet").collect()]
    got = queries.op7_tokens(spark, SF)
    assert [tuple(r) for r in got.orderBy("start").collect()] == want_rows(docs, library)
    assert dict(got.dtypes) == {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"}

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from helpers import documents, prose
from postlake.llm import decontam as d
from postlake.llm import queries

SF = "/root/testdata/sf0.001"


def norm(text):
    raw = re.sub(rb"[\x20\x09-\x0D]+", b" ", (text or "").encode())
    return bytes(c + 32 if 65 <= c <= 90 else c for c in raw)


def brute_edits(pattern: bytes, text: bytes) -> int:
    """Least edits of the pattern against any substring (Sellers)."""
    cost = np.zeros(len(text) + 1, int)
    for i, c in enumerate(pattern, 1):
        new = np.empty_like(cost)
        new[0] = i
        miss = np.frombuffer(text, np.uint8) != c
        new[1:] = np.minimum(cost[:-1] + miss, cost[1:] + 1)
        cost = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
    return int(cost.min())


def brute(docs, items):
    out = set()
    for k, t in docs:
        for i, p in items:
            p = norm(p).strip(b" ")
            if len(p) >= d.LEAST_CHARS and any(brute_edits(p[a:b], norm(t)) <= d.budget(b - a) for a, b in d.item_windows(len(p))):
                out.add((k, i))
    return out


def edited(rng, text, n):
    for _ in range(n):
        at = rng.randrange(len(text))
        text = rng.choice([text[:at] + text[at + 1:], text[:at] + "z" + text[at:], text[:at] + "q" + text[at + 1:]])
    return text


def planted(rng):
    items = [(i, prose(rng, 4 + 3 * (i % 16))) for i in range(30)] + [(50, "Grüße, ñandú éléphant ça où?" * 2), (51, "short"), (52, None), (53, "")]
    docs = []
    for k in range(120):
        text = prose(rng, rng.randint(0, 120))
        if k % 2:
            item = rng.choice(items[:31])[1]
            piece = item if k % 3 else item[len(item) // 4:]
            piece = edited(rng, piece, rng.randint(0, 14)) if piece else ""
            piece = re.sub(" ", lambda m: rng.choice([" ", "\n", "  "]), piece).upper() if k % 5 == 0 else piece
            at = rng.randint(0, len(text))
            text = text[:at] + " " + piece + " " + text[at:]
        docs.append((k, text))
    return docs + [(200, None), (201, ""), (202, "a" * 5000), (203, "the " * 2000)], items


def test_finds_what_brute_force_finds(spark):
    docs, items = planted(random.Random(11))
    want = brute(docs, items)
    assert len(want) > 20
    df = documents(spark, docs, {"start": 1, "item_id": "clash"})
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = d.contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in out} == want and len(out) == len(want)
    texts = dict(docs)
    for r in out:
        assert 0 <= r.start < r.end <= len(texts[r.doc_id]) and r.windows >= 1
        if r.edits == 0 and r.windows == 1 and len(norm(dict(items)[r.item_id])) <= d.WINDOW and "  " not in texts[r.doc_id]:
            assert norm(texts[r.doc_id][r.start:r.end]).strip(b" ") == norm(dict(items)[r.item_id]).strip(b" ")
    kept = d.drop_contaminated(df, bench)
    assert {r.doc_id for r in kept.collect()} == set(texts) - {k for k, _ in want} and kept.columns == df.columns


def test_blocks_of_benchmark_and_of_long_texts(spark, monkeypatch):
    docs, items = planted(random.Random(12))
    whole = " ".join(t or "" for _, t in docs)
    want = brute([(1, whole)], items)
    monkeypatch.setattr(d, "BENCHMARK_BLOCK", 1500)
    out = d.contaminated(documents(spark, [(1, whole)]), spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in out.collect()} == want
    index = d.Index(items)
    pieces = d.find_in_texts(index, pa.array(["x", whole]), size=8000)
    assert {(k, index.items[i]) for k, i in pieces} == want


@pytest.mark.parametrize("length", range(d.LEAST_CHARS, 120))
def test_bound_is_positive(length):
    assert d.bound(length) >= 1


def test_empty_tables(spark):
    docs, bench = documents(spark, [(1, "text")]), spark.createDataFrame([], "item_id long, text string")
    assert d.contaminated(docs, bench).collect() == []
    assert d.contaminated(docs.limit(0), bench).collect() == []
    assert d.drop_contaminated(docs, bench).count() == 1


def test_drops_rows_not_ids(spark):
    rng = random.Random(13)
    item, clean = prose(rng, 30), [prose(rng, 40) for _ in range(4)]
    rows = [(None, clean[0] + " " + item), (None, clean[0]), (None, clean[1]), (None, None), (7, item), (7, clean[2]), (7, item), (8, clean[3]), (8, clean[3])]
    kept = d.drop_contaminated(documents(spark, rows).repartition(3), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted((str(i), str(t)) for i, t in rows if item not in (t or ""))


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(SF + "/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(SF + "/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in queries.op5_decontamination(spark, SF).collect()}
    assert got >= {(k, i) for k, t in docs for i, p in items if norm(p) in norm(t)}
    assert got <= brute([x for x in docs if x[0] in {k for k, _ in got}], items)


@pytest.mark.parametrize("length", [60, 66, 79])
def test_passages_of_sixty_bytes_are_found_anywhere(length):
    """The guarantee: a verbatim passage of 60 bytes or more of a longer item, wherever it begins."""
    rng = random.Random(length)
    item = prose(rng, 200)[:240]
    index = d.Index([(1, item)])
    texts = [f"{prose(rng, 20)} {item[at:at + length]} {prose(rng, 20)}" for at in range(0, 240 - length + 1)]
    found = {k for k, _ in d.find_in_texts(index, pa.array(texts, pa.string()))}
    assert found == set(range(len(texts)))


@pytest.mark.parametrize("run", [1, 3500, 6000, 40_000])
def test_white_space_at_a_cut_hides_nothing(run):
    """A passage whose words are parted by a long run of white space at a cut of a long text is found, and placed."""
    rng = random.Random(run)
    item = prose(rng, 30)[:84]
    half = item.index(" ", 40)
    before = ((prose(rng, 1000) + " ") * 120)[:d.DOCUMENT_BLOCK - half - 1]
    text = before + " " + item[:half] + " " * run + item[half + 1:] + " " + prose(rng, 100)
    assert len(before) + run > d.DOCUMENT_BLOCK - 100 or run == 1
    for t in (text, "é" + text, text.replace("  ", "\n\t") if run > 1 else text):
        found = d.find_in_texts(d.Index([(9, item)]), pa.array(["x", t], pa.string()))
        assert list(found) == [(1, 0)]
        start, end, edits, _ = found[1, 0]
        raw = t.encode()[start:end].decode("utf-8", "ignore")
        assert edits == 0 and norm(raw).strip(b" ") == norm(item)


def test_budget_is_rounded_up():
    assert d.budget(60) == 5 and d.budget(50) == 4 and d.budget(20) <= 2
    assert d.item_windows(85) == [(0, 60), (10, 70), (20, 80), (25, 85)]

import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from helpers import documents
from postlake.llm import divergence as d
from postlake.llm import queries

SF = "/root/testdata/sf0.001"


def terms_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute(rows, least, top):
    count, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in ((t, a or "", b or "") for _, t, a, b in rows):
        groups[lang].add(source)
        count[lang, source].update(terms_of(text))
        docs[lang].update(set(terms_of(text)))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= least]

        def shares(n):
            total = sum(n[t] for t in kept) + 2 * len(kept)
            return {t: 1 + 10 ** 9 * (n[t] + 2) // total for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k) for k, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def some_rows(seed, docs=400, sources=9):
    rng = np.random.default_rng(seed)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["Éa", "éa", "ÀB", "漢字", "Zz", "ß"]
    weight = 1 / np.arange(1, len(words) + 1)
    rows = []
    for i in range(docs):
        source = int(rng.integers(0, sources))
        own = np.roll(weight, source * 3)
        text = " ".join(rng.choice(words, size=int(rng.integers(0, 40)), p=own / own.sum()))
        text = text.upper() if i % 11 == 0 else text.replace(" ", ["-", "\n", "1", "_", "`"][i % 5])
        rows.append((i, text, ["en", "de", None, ""][min(3, int(rng.integers(0, 9)) // 3)], None if source == 4 else f"s{source}"))
    return rows + [(900, None, "en", "silent"), (901, "", "fr", "alone"), (902, "once only", "es", "a"), (903, "twice", "es", "b"), (904, None, None, None)]


def found(spark, rows, **how):
    df = documents(spark, rows, {"term": 1, "n": 2, "sid": 3, "slice": 4, "value": 5, "part": "x", "item": None})
    return sorted(map(tuple, d.audit_sources(df.repartition(3), **how).collect()))


def test_matches_brute_force(spark):
    rows = some_rows(1)
    want = brute(rows, 10, 10)
    assert found(spark, rows) == want
    kinds = Counter((r[0], r[2]) for r in want)
    assert kinds["en", "term"] > 20 and kinds["es", "pair"] == 2 and ("fr", "pair") not in kinds
    assert {r[4] for r in want if r[0] == "es"} == {0}


def test_slices_steps_and_pieces(spark, monkeypatch):
    rows = some_rows(2, docs=300, sources=30)
    rows[5] = (5, " ".join(r[1] or "" for r in rows[:200]), "en", "s1")
    for name, value in (("SLICE", 40), ("SLICE_ROWS", 1), ("PIECE", 500), ("STEP", 50)):
        monkeypatch.setattr(d, name, value)
    assert found(spark, rows, least=4, top=3) == brute(rows, 4, 3)


def test_repeated_rows_count_each(spark):
    rows = [(1, "a b", "en", "x")] * 12 + [(1, "a c", "en", "y")] * 3
    assert found(spark, rows) == brute(rows, 10, 10)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_terms_of_documents():
    texts = ["a B.b é\x00É", None, "", "ÀÀ ab", "AB", "-", "z"]
    doc, terms, count = d.document_terms(pa.array(texts, pa.string()))
    got = sorted(zip(doc.tolist(), terms.to_pylist(), count.tolist()))
    assert got == sorted((i, t, n) for i, x in enumerate(texts) for t, n in Counter(terms_of(x)).items())


def test_shares_are_exact():
    rng = np.random.default_rng(0)
    for top in (10, 10 ** 6, 9 * 10 ** 15):
        total = rng.integers(top // 2, top, 200)
        count = (rng.random(200) * (total - 2)).astype(np.int64)
        assert d.share(count, total).tolist() == [1 + 10 ** 9 * (int(c) + 2) // int(t) for c, t in zip(count, total)]


def test_postings_pairs_are_never_rows():
    """The scatter returns a row for each pair of sources, however many terms they share."""
    sources = pa.table({"lang": ["en"] * 3, "source": ["a", "b", "c"], "sid": [0, 1, 2], "words": [5000, 5000, 10], "vocabulary": [1000] * 3, "lang_words": [10_010] * 3})
    postings = pa.table({"term": [f"t{i:04d}" for i in range(1000)] * 2, "sid": [0] * 1000 + [1] * 1000, "n": [5] * 2000, "lang_n": [10] * 2000})
    out = d.scatter(postings, sources)
    assert Counter(out.column("part").to_pylist())["pair"] <= 2


@pytest.mark.parametrize("sf", [SF])
def test_query_matches_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{sf}/documents.parquet')")
    want = con.execute(f"select lang, source, part, item, value, rank from ({queries.ORACLES['op12_divergence']})").fetchall()
    got = queries.op12_divergence(spark, sf)
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(want) > 50
    assert dict(got.dtypes) == {"lang": "string", "source": "string", "part": "string", "item": "string", "value": "bigint", "rank": "int"}

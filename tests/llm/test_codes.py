import hashlib
import math
from collections import defaultdict

import duckdb
import numpy as np
import pytest

from postlake.llm import codes, queries

SF = "/root/testdata/sf0.001"


def distances(x, entries):
    return [sum((a - b) ** 2 for a, b in zip(x, e)) for e in entries]


def brute(rows, parts=16, entries=64, rounds=2):
    """Codes, errors and codebooks in Python's integers, every part against every entry."""
    kept = [(i, [math.floor(256 * x) if abs(x) < 2 ** 52 else 256 * int(x) for x in v], lab, v) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    width = -(-max(len(x) for _, x, _, _ in kept) // parts)
    cut = lambda x: [(x + [0] * (parts * width - len(x)))[k * width:(k + 1) * width] for k in range(parts)]
    kept = [(i, cut(x), lab, v) for i, x, lab, v in kept]
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[3]))[:entries]
    books = [[r[1][k] for r in first] for k in range(parts)]
    for turn in range(rounds + 1):
        found = [[min((d, e) for e, d in enumerate(distances(r[1][k], books[k]))) for k in range(parts)] for r in kept]
        if turn < rounds:
            for k in range(parts):
                own = defaultdict(list)
                for r, f in zip(kept, found):
                    own[f[k][1]].append(r[1][k])
                books[k] = [[sum(c) // len(own[e]) for c in zip(*own[e])] if e in own else b for e, b in enumerate(books[k])]
    cap = lambda n: min(n, 2 ** 63 - 1)
    sums = defaultdict(int)
    for r, f in zip(kept, found):
        sums[r[2]] += cap(sum(d for d, _ in f))
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return sorted(((r[0], "".join(f"{e:02x}" for _, e in f), cap(sum(d for d, _ in f)), cap(sums[r[2]]), digest) for r, f in zip(kept, found)), key=str)


def found(spark, rows, monkeypatch):
    df = spark.createDataFrame([(i, v, lab, "clash", 1, b"x") for i, v, lab in rows], "vec_id long, embedding array<double>, label int, id string, error int, code binary")
    monkeypatch.setattr(queries, "table", lambda *a: df.repartition(3))
    return sorted((tuple(r) for r in queries.op11_codes(spark, SF).collect()), key=str)


def clusters(rng, n, dim, groups=20):
    centres = rng.normal(0, 1, (groups, dim))
    return centres[rng.integers(0, groups, n)] + rng.normal(0, 0.05, (n, dim))


@pytest.mark.parametrize("kind", ["normal", "clusters", "few values", "alike", "one", "flat"])
def test_trees_find_the_nearest_entry(kind):
    rng = np.random.default_rng(3)
    make = {"normal": lambda n: rng.normal(0, 50, (n, 4)), "clusters": lambda n: 100 * clusters(np.random.default_rng(1), n, 4),
            "few values": lambda n: rng.integers(0, 3, (n, 4)), "alike": lambda n: np.ones((n, 4)), "one": lambda n: rng.normal(0, 9, (n, 4)),
            "flat": lambda n: rng.integers(0, 40, (n, 1))}[kind]
    entries, x = (np.floor(make(n)).astype(np.float64) for n in (1 if kind == "one" else 150, 700))
    tree = codes.Gnat(entries)
    number, square = tree.nearest(x)
    want = ((x[:, None] - entries[None]) ** 2).sum(axis=2)
    assert (number == want.argmin(axis=1)).all() and (square == want.min(axis=1)).all()  # argmin: the smallest number
    if kind == "clusters":
        assert tree.looked < 0.5 * len(x) * len(entries)  # whole subtrees are left out
    if kind == "normal":
        assert tree.looked < 0.8 * len(x) * len(entries)


def test_stored_ranges_hold():
    entries = np.floor(np.random.default_rng(5).normal(0, 100, (64, 4)))

    def below(node):
        return node[0].tolist() if len(node) == 1 else [m for s, c in zip(node[0].tolist(), node[3]) for m in [s, *(below(c) if c else [])]]

    splits, low, high, children = codes.Gnat(entries).root
    assert sorted(below(codes.Gnat(entries).root)) == list(range(64))
    for i, s in enumerate(splits):
        for j, t in enumerate(splits):
            apart = [np.sqrt(((entries[s] - entries[m]) ** 2).sum()) for m in [t, *(below(children[j]) if children[j] else [])]]
            assert low[i, j] <= min(apart) and max(apart) <= high[i, j]


def test_large_numbers_are_exact():
    rng = np.random.default_rng(6)
    entries = np.array([[int(v) * 10 ** 30 + int(w) for v, w in rng.integers(-9, 9, (3, 2))] for _ in range(60)], object)
    x = np.array([[int(v) * 10 ** 30 + int(w) for v, w in rng.integers(-9, 9, (3, 2))] for _ in range(80)], object)
    number, square = codes.Gnat(entries).nearest(x)
    for row, n, s in zip(x, number, square):
        assert (s, n) == min((d, e) for e, d in enumerate(distances(row, entries)))


def test_matches_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(v) for v in x], [None, 1, 2, 3][i % 4]) for i, x in enumerate(clusters(rng, 180, 32))]
    rows += [(500 + i, rows[i][1], None) for i in range(30)] + [(3, rows[3][1], 3), (3, rows[9][1], 3), (None, rows[2][1], 1)]
    rows += [(900, None, 1), (901, [1.0, None] + [0.0] * 30, 1), (902, [float("nan")] * 32, 1), (903, [float("-inf")] * 32, 2)]
    got = found(spark, rows, monkeypatch)
    assert got == brute(rows) and len(got) == 213


def test_odd_vectors(spark, monkeypatch):
    short = [(i, [float(i % 7)] * (i % 5), i % 2) for i in range(90)]
    assert found(spark, short, monkeypatch) == brute(short)
    few = [(1, [0.5] * 16, 1), (2, [-0.001] * 16, 1)]
    assert found(spark, few, monkeypatch) == brute(few)
    huge = [(i, [1e30 * (i % 3) - 5e29, 0.25 * i, -1e300 if i == 7 else 1.0], None) for i in range(80)]
    assert found(spark, huge, monkeypatch) == brute(huge)
    assert found(spark, [(1, [], 2)], monkeypatch) == brute([(1, [], 2)])
    assert found(spark, [], monkeypatch) == [] and found(spark, [(1, None, 1)], monkeypatch) == []


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    want = con.execute(f"select vec_id, code, error, label_error, codebooks_sha256 from ({queries.ORACLES['op11_codes']})").fetchall()
    got = queries.op11_codes(spark, SF)
    assert sorted(map(tuple, got.collect())) == sorted(want) and want
    assert dict(got.dtypes) == {"vec_id": "bigint", "code": "string", "error": "bigint", "label_error": "bigint", "codebooks_sha256": "string"}

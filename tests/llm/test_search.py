import math

import duckdb
import numpy as np
import pytest

from postlake.llm import queries, search

SF = "/root/testdata/sf0.001"


def brute(rows, wanted, k):
    ok = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q in sorted({(i, tuple(v)) for i, v in ok if wanted(i)}):
        best = sorted((-max(-2 ** 63, min(2 ** 63 - 1, sum(a * b for a, b in zip(q[1], v)))), i) for i, v in ok if i != q[0] and len(v) == len(q[1]))[:k]
        out += [(q[0], r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def found(spark, rows, wanted, k, **how):
    df = spark.createDataFrame([(i, v, 1.0, 2) for i, v in rows], "vec_id long, embedding array<double>, score double, rank int")
    out = search.top_k(df.repartition(3), df.where(df.vec_id.isin([i for i, _ in rows if i is not None and wanted(i)])), k, **how)
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("dim,block", [(64, 4096), (7, 6), (1, 4096)])
def test_matches_brute_force(spark, dim, block):
    rng = np.random.default_rng(dim)
    rows = [(i, [float(x) for x in rng.normal(0, 0.2, dim) + (i % 3)]) for i in range(300)]
    rows += [(400 + i, rows[i % 5][1]) for i in range(20)]  # ties
    assert found(spark, rows, lambda i: i % 10 == 0, 5, query_block=block) == brute(rows, lambda i: i % 10 == 0, 5)


def test_odd_vectors(spark):
    big = 1e30
    rows = [(0, [1.0, -0.001]), (10, [big, 1.0]), (1, [big, -big]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, []), (20, []), (7, [1.0]), (30, [0.5]), (8, [0.0, 0.0]), (8, [0.0, 0.0]), (None, [1.0, 1.0]), (0, [1.0, -0.001])]
    assert found(spark, rows, lambda i: i % 10 == 0, 3) == brute(rows, lambda i: i % 10 == 0, 3)
    assert found(spark, [], lambda i: True, 3) == []
    assert found(spark, [(0, [1.0])], lambda i: True, 3) == []


def test_bounds_hold():
    rng = np.random.default_rng(4)
    a, b = np.floor(256 * rng.normal(0, 1, (40, 10))), np.floor(256 * rng.normal(0, 1, (50, 10)))
    turn = search.transform(b)
    assert np.allclose(turn @ turn.T, np.eye(10))
    last = np.full((40, 50), np.inf)
    for edges in search.resolutions(10):
        bound = search.segment_statistics(a @ turn, edges) @ search.segment_statistics(b @ turn, edges).T
        assert (bound >= a @ b.T - 1e-6).all()
        last = np.minimum(last, bound)
    assert last.mean() < np.outer(np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)).mean()
    assert [e[0] for e in search.resolutions(64)] == [0] * 5 and search.resolutions(1) == [[0, 1]] and search.resolutions(0) == []


def exact_share(x, ids, queries_every):
    sample = slice(0, 4096)
    q = ids % queries_every == 0
    s = search.Searcher(ids[q], x[q], 5, search.transform(x[sample]), search.first_scores(ids[q], x[q], ids[sample], x[sample], 5))
    for lo in range(0, len(ids), search.CHUNK):
        s.add(ids[lo:lo + search.CHUNK], x[lo:lo + search.CHUNK])
    score = x[q] @ x.T
    score[ids[q][:, None] == ids[None]] = -np.inf
    want = sorted((int(i), *map(int, r)) for i, row in zip(ids[q], score) for r in sorted(zip(-row, ids))[:5])
    assert sorted(zip(s.ids[s.query].tolist(), (-s.score).tolist(), s.found.tolist())) == want
    assert s.pairs == int(np.isfinite(score).sum())
    return s.exact / s.pairs


def test_few_pairs_get_exact_scores():
    rng = np.random.default_rng(8)
    ids = np.arange(6000)
    centres = rng.normal(0, 1, (40, 64))
    clustered = np.floor(256 * (centres[rng.integers(0, 40, 6000)] + rng.normal(0, 0.1, (6000, 64))))
    assert exact_share(clustered, ids, 50) < 0.04  # a cluster is a fortieth of all
    given = spark_free_vectors("/root/testdata/sf0.1/embeddings.parquet")
    assert exact_share(given, np.arange(len(given)), 50) < 0.15  # directions without structure


def spark_free_vectors(path):
    import pyarrow.parquet as pq

    return np.floor(256 * np.array(pq.read_table(path, columns=["embedding"]).column(0).to_pylist(), np.float64))


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{SF}/embeddings.parquet')")
    want = con.execute(f"select query_id, rank, vec_id, score from ({queries.SEARCH_SQL}) order by 1, 2").fetchall()
    got = queries.op10_search(spark, SF)
    assert [tuple(r) for r in got.orderBy("query_id", "rank").collect()] == want and len(want) == 50
    assert dict(got.dtypes) == {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"}

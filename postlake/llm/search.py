"""Exact top-k search by integer inner product with multi-resolution segment statistics.

A vector cut into segments of L components is summed up by each segment's mean m and deviation s. For two vectors the
inner product over a segment is at most L (m m' + s s'), so the sum over segments bounds the score from above (and the
distance from below). All vectors are first turned by one orthonormal transform, fitted on a sample, that packs what the
vectors share into the first components. Resolutions go from coarse to fine: few wide segments, then ever more single
components with one segment for the rest; a pair whose bound falls below the query's k-th best score is dropped, and
only what survives the finest resolution gets its exact score. The k-th best score starts with that among the sample.

How much bites depends on the vectors: clustered ones are dropped at coarse resolutions, directions without any structure
only when most components are known (README has figures).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import materialize, prepare, tidied

SCALE = 256
QUERY_BLOCK = 4096
CHUNK = 1024
#: Vectors of the smallest hashes on which the transform is fitted and from which the k-th best scores start.
SAMPLE_ROWS = 4096
#: Pairs whose exact scores are computed at a time.
PAIRS = 1 << 15
LONG_MAX = 2 ** 63 - 1


def to_integers(flat: np.ndarray, dim: int) -> np.ndarray:
    return np.floor(SCALE * flat.astype(np.float64)).reshape(-1, dim)


def resolutions(dim: int) -> list[list[int]]:
    """Edges of the segments, coarse to fine: one, four, then a quarter, a half and three quarters of single components."""
    out = [[0, dim], sorted({round(dim * i / 4) for i in range(5)})]
    out += [[*range(h + 1), dim] for h in sorted({dim // 4, dim // 2, 3 * dim // 4} - {0}) if h < dim]
    return [e for i, e in enumerate(out) if dim and e not in out[:i]]


def segment_statistics(x: np.ndarray, edges: list[int]) -> np.ndarray:
    """Rows whose inner product bounds that of the vectors: sqrt(L) times the means and deviations of the segments."""
    out = []
    for lo, hi in zip(edges[:-1], edges[1:]):
        if hi == lo + 1:  # a mean without deviation
            out.append(x[:, lo])
        else:
            root = np.sqrt(hi - lo)
            out += [root * x[:, lo:hi].mean(axis=1), root * x[:, lo:hi].std(axis=1)]
    return np.stack(out, axis=1) if out else np.zeros((len(x), 1))


def transform(sample: np.ndarray) -> np.ndarray:
    """The orthonormal transform whose first components hold most of the sample's energy."""
    dim = sample.shape[1]
    energy = sample.T @ sample
    if not dim or len(sample) < 2 or not np.isfinite(energy).all():
        return np.eye(dim)
    return np.ascontiguousarray(np.linalg.eigh(energy)[1][:, ::-1])


def _exact_in_doubles(a: np.ndarray, b: np.ndarray) -> bool:
    return not a.size or not b.size or np.abs(a).max() * np.abs(b).max() * a.shape[1] < 2.0 ** 53


def first_scores(ids: np.ndarray, vectors: np.ndarray, sample_ids: np.ndarray, sample: np.ndarray, k: int) -> np.ndarray:
    """Each query's k-th best exact score among the sample (minus infinity, if it has fewer or the numbers are too large)."""
    out = np.full(len(ids), -np.inf)
    if len(sample) < k or not _exact_in_doubles(vectors, sample):
        return out
    for lo in range(0, len(ids), 256):
        score = vectors[lo:lo + 256] @ sample.T
        score[ids[lo:lo + 256, None] == sample_ids[None]] = -np.inf
        out[lo:lo + 256] = np.partition(score, len(sample) - k, axis=1)[:, len(sample) - k]
    return out


def big_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of row pairs with Python's integers, cut to long."""
    sums = (sum(int(x) * int(y) for x, y in zip(u, v)) for u, v in zip(a, b))
    return np.array([max(-LONG_MAX - 1, min(LONG_MAX, s)) for s in sums], np.int64)


class Searcher:
    """The best k candidates so far of each query of one dimension."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, turn: np.ndarray | None = None, least: np.ndarray | None = None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.turn = np.eye(vectors.shape[1]) if turn is None else turn
        self.edges = resolutions(vectors.shape[1])
        turned = vectors @ self.turn
        self.stats = [segment_statistics(turned, e) for e in self.edges]
        self.length = np.sqrt((vectors ** 2).sum(axis=1))
        self.query, self.found, self.score = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(len(ids), -np.inf) if least is None else least  # the k-th best score so far
        self.pairs = self.exact = 0  # pairs that were looked at, and those that got their exact score

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        """Look at some candidates: each resolution drops pairs, and whole candidates that no query keeps, for the next."""
        alive = ids[None, :] != self.ids[:, None]
        self.pairs += int(alive.sum())
        turned, length = x @ self.turn, np.sqrt((x ** 2).sum(axis=1))
        for mine, edges in zip(self.stats, self.edges):
            if not len(ids):
                return
            bound = mine @ segment_statistics(turned, edges).T
            # the transform, the statistics and their products are rounded
            bound += 1e-9 * np.outer(self.length, length) + 1e-6
            alive &= ~(bound < self.least[:, None])
            some = alive.any(axis=0)
            if not some.all():
                ids, x, turned, length, alive = ids[some], x[some], turned[some], length[some], alive[:, some]
        q, c = np.nonzero(alive)
        self.exact += len(q)
        doubles = _exact_in_doubles(self.vectors, x)  # whole numbers below 2**53: any order of summing is exact
        for lo in range(0, len(q), PAIRS):
            mine, theirs = q[lo:lo + PAIRS], c[lo:lo + PAIRS]
            score = np.einsum("ij,ij->i", self.vectors[mine], x[theirs]) if doubles else big_scores(self.vectors[mine], x[theirs])
            good = score >= self.least[mine]
            self._merge(mine[good], ids[theirs[good]], score[good].astype(np.int64))

    def _merge(self, q, ids, score) -> None:
        q, ids, score = (np.concatenate(x) for x in ((self.query, q), (self.found, ids), (self.score, score)))
        order = np.lexsort((ids, ~score, q))  # ~ reverses longs without overflow
        q, ids, score = q[order], ids[order], score[order]
        first = np.searchsorted(q, np.arange(len(self.ids)))
        rank = np.arange(len(q)) - first[q]
        last = rank == self.k - 1
        self.least[q[last]] = score[last]
        top = rank < self.k
        self.query, self.found, self.score = q[top], ids[top], score[top]


def _vectors(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat components and lengths of a list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False), np.asarray(column.value_lengths(), np.int64)


def _columns(table: pa.Table) -> tuple:
    """ids, flat components and lengths of a table of id, x."""
    lists = table.column("x").combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.float64()))
    return (table.column("id").to_numpy(), *_vectors(lists))


def _by_length(ids: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, whole numbers) of the vectors of each length."""
    starts, out = np.concatenate([[0], np.cumsum(lengths)]), {}
    for dim in np.unique(lengths).tolist():
        at = np.nonzero(lengths == dim)[0]
        out[dim] = (ids[at], to_integers(flat[starts[at][:, None] + np.arange(dim)], dim) if dim else np.zeros((len(at), 0)))
    return out


def top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
          query_block: int = QUERY_BLOCK, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """For each query the ``k`` best of all vectors but its own: query_id, rank, vec_id, score.

    Components count as floor(256 x). Rows with a null id, or a vector that is null or holds a null or non-finite
    component, take no part. Candidates with the query's id are its own; other repeated rows are candidates each, and a
    repeated query is searched once. Only vectors of a query's length are compared. Ties go to the smaller id. Queries
    pass the driver in blocks of at most ``query_block`` rows; each block searches all vectors in one job, in which a
    task keeps k candidates for each query. ``sample_rows`` vectors go to the driver for the transform and the first
    scores; they are a help only, and are found like all others.
    """
    spark = vectors.sparkSession
    prepare(spark)

    def usable(df):
        x = F.col(vector_col)
        whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
        return df.where(F.col(id_col).isNotNull() & x.isNotNull() & F.coalesce(whole, F.lit(False))) \
            .select(F.col(id_col).cast("long").alias("id"), x.cast("array<double>").alias("x"))

    rows, asked = usable(vectors), materialize(usable(queries).distinct(), "search-queries")
    blocks = max(1, -(-asked.count() // (query_block // 2)))  # half full on average, so that none is above
    picked = rows.orderBy(F.xxhash64("id", "x"), "id").limit(sample_rows).toArrow().combine_chunks()
    sample = _by_length(*_columns(picked))
    turns = {dim: transform(x) for dim, (_, x) in sample.items()}
    found = []
    for block in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("id", "x"), F.lit(blocks)) == block).toArrow().combine_chunks() if blocks > 1 else asked.toArrow().combine_chunks()
        if not own.num_rows:
            continue
        asked_by = {}
        for dim, (ids, x) in _by_length(*_columns(own)).items():
            others = sample.get(dim, (ids[:0], x[:0]))
            asked_by[dim] = (ids, x, turns.get(dim), first_scores(ids, x, *others, k))
        sent = spark.sparkContext.broadcast(asked_by)

        def search(batches, sent=sent):
            searchers = {dim: Searcher(ids, x, k, turn, least.copy()) for dim, (ids, x, turn, least) in sent.value.items()}
            for b in tidied(batches):
                cid, (cflat, clen) = b.column(0).to_numpy(), _vectors(b.column(1))
                begin = np.concatenate([[0], np.cumsum(clen)])
                for dim, searcher in searchers.items():
                    at = np.nonzero(clen == dim)[0]
                    for lo in range(0, len(at), CHUNK):
                        some = at[lo:lo + CHUNK]
                        x = cflat[begin[some][:, None] + np.arange(dim)] if dim else np.zeros((len(some), 0))
                        searcher.add(cid[some], to_integers(x, dim) if dim else x)
            for s in searchers.values():
                if len(s.query):
                    yield pa.RecordBatch.from_arrays([pa.array(s.ids[s.query]), pa.array(s.found), pa.array(s.score)],
                                                     names=["query_id", "vec_id", "score"])

        part = rows.mapInArrow(search, "query_id long, vec_id long, score long")
        found.append(materialize(part, "search-block") if blocks > 1 else part)
    if not found:
        found = [spark.createDataFrame([], "query_id long, vec_id long, score long")]
    union = found[0]
    for f in found[1:]:
        union = union.union(f)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return union.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

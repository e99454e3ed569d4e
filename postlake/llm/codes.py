"""Vector codes: product quantization whose nearest entries are found in GNATs, with whole numbers throughout.

A vector's components become floor(256 x) and are cut into parts; each part is coded as the number of its nearest entry in its
position's codebook. The entries of a codebook are held in a GNAT (geometric near-neighbour access tree): a node has
split points, far from each other, each with the entries that are nearest to it, and stores for every pair of a split
point and a child the smallest and largest distance between them. The distance from a query to a split point then
shows which children are, as a whole, strictly farther away than the best entry so far. Those bounds are roots, rounded
outwards; squared distances are whole numbers and compared exactly, ties by the entries' numbers.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare, tidied

SCALE = 256
PARTS = 16
ENTRIES = 64
ROUNDS = 2
#: Split points of a node; a node of so many entries or fewer is a leaf.
DEGREE = 8
LONG_MAX = 2 ** 63 - 1
#: Components up to this are held as doubles: squared distances of up to 1,024 components are then exact.
SMALL = 2 ** 20
_LIMB = 31


def small_enough(largest: float, width: int) -> bool:
    return SCALE * largest < SMALL and width <= 1024


def whole(flat: np.ndarray, small: bool) -> np.ndarray:
    """floor(256 x): doubles that are whole numbers, or Python's integers if some are too large."""
    if small:
        return np.floor(SCALE * flat)
    return np.array([math.floor(SCALE * x) if abs(x) < 2.0 ** 52 else SCALE * int(x) for x in flat.tolist()], object)


def _roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers below and above the square roots, also after a sum and a difference of two of them."""
    if squares.dtype == object:
        low = np.array([math.isqrt(int(s)) for s in squares.ravel()], object).reshape(squares.shape)
        return low, low + 1
    root = np.sqrt(squares)
    return root * (1 - 1e-12), root * (1 + 1e-12)


class Gnat:
    """The entries (k x w, whole numbers) of one codebook, to find the nearest one of each query."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE):
        self.entries, self.degree = entries, degree
        self.looked = 0  # squared distances that were computed
        self.root = self._node(np.arange(len(entries)))

    def _squares(self, x: np.ndarray, entry: int) -> np.ndarray:
        return ((x - self.entries[entry]) ** 2).sum(axis=1)

    def _node(self, members: np.ndarray):
        """(members,) of a leaf, or (splits, low, high, children); low[i, j] and high[i, j]: distances of split i to all of child j."""
        if len(members) <= self.degree:
            return (members,)
        own = self.entries[members]
        splits, apart = [0], [self._squares(own, members[0])]
        while len(splits) < self.degree:  # the next split point is the entry farthest from those there are
            near = np.min(apart, axis=0)
            far = int(near.argmax())
            if not near[far]:
                break
            splits.append(far)
            apart.append(self._squares(own, members[far]))
        if len(splits) == 1:
            return (members,)  # all alike
        apart = np.array(apart)
        owner = apart.argmin(axis=0)
        owner[splits] = np.arange(len(splits))
        inside = [np.nonzero(owner == j)[0] for j in range(len(splits))]
        low = np.stack([_roots(apart[:, i].min(axis=1))[0] for i in inside], axis=1)
        high = np.stack([_roots(apart[:, i].max(axis=1))[1] for i in inside], axis=1)
        rest = [i[i != s] for i, s in zip(inside, splits)]
        return members[splits], low, high, [self._node(members[i]) if len(i) else None for i in rest]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each query's nearest entry (the smallest of those equally near), and the squared distance."""
        best, number = np.full(len(x), np.inf, x.dtype), np.zeros(len(x), np.int64)
        self._visit(self.root, x, np.arange(len(x)), best, number)
        return number, best

    def _look(self, entry: int, x, rows, best, number) -> np.ndarray:
        square = self._squares(x[rows], entry)
        self.looked += len(rows)
        better = ((square < best[rows]) | ((square == best[rows]) & (entry < number[rows]))).astype(bool)
        best[rows[better]], number[rows[better]] = square[better], entry
        return square

    def _visit(self, node, x, rows, best, number) -> None:
        if len(node) == 1:
            for entry in node[0].tolist():
                self._look(entry, x, rows, best, number)
            return
        splits, low, high, children = node
        alive = np.ones((len(rows), len(splits)), bool)
        for i, entry in enumerate(splits.tolist()):
            on = np.nonzero(alive[:, i])[0]
            if not len(on):
                continue
            below, above = _roots(self._look(entry, x, rows[on], best, number))
            reach = _roots(best[rows[on]])[1]
            # strictly farther than the best so far, so that no entry equally near is lost
            gone = ((below - reach)[:, None] > high[i]) | ((above + reach)[:, None] < low[i])
            alive[on] &= ~gone.astype(bool)
        for j, child in enumerate(children):
            some = rows[alive[:, j]] if child is not None else rows[:0]
            if len(some):
                self._visit(child, x, some, best, number)


class Codebooks:
    """Entries (k x w, whole numbers) of every part's position, and their trees."""

    def __init__(self, books: list[np.ndarray], small: bool):
        self.books, self.small = books, small

    @property
    def width(self) -> int:
        return self.books[0].shape[1]

    def trees(self) -> list[Gnat]:
        return [Gnat(b) for b in self.books]

    def sha256(self) -> str:
        """Of all entries' decimal components by part, entry and position, joined with commas."""
        return hashlib.sha256(",".join(str(int(c)) for b in self.books for c in b.ravel()).encode()).hexdigest()


def _matrix(column: pa.ListArray, dim: int, small: bool) -> np.ndarray:
    """The whole numbers of a list column as rows of ``dim``; shorter vectors end with zeros."""
    sizes = np.asarray(column.value_lengths(), np.int64)
    flat = whole(column.flatten().to_numpy(zero_copy_only=False), small)
    if len(flat) == len(sizes) * dim:
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), flat.dtype)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label, x of the rows whose vector is not null and has neither null nor non-finite components."""
    x = F.col(vector_col)
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return vectors.where(x.isNotNull() & F.coalesce(finite, F.lit(False))) \
        .select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), x.cast("array<double>").alias("x"))


def _sums(rows: DataFrame, books: Codebooks, parts: int) -> dict[int, tuple[int, list[int]]]:
    """Number and componentwise sums of the vectors' parts assigned to each entry (slot: part * entries + entry)."""
    width, small, entries = books.width, books.small, len(books.books[0])
    sent = rows.sparkSession.sparkContext.broadcast(books.books)
    names = ["slot", "limb", "n", *[f"s{i}" for i in range(width)]]

    def add(batches):
        trees = [Gnat(b) for b in sent.value]
        count = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, width), np.int64 if small else object)
        for b in tidied(batches):
            x = _matrix(b.column(0), parts * width, small)
            for k, tree in enumerate(trees):
                own = x[:, k * width:(k + 1) * width]
                number, _ = tree.nearest(own)
                np.add.at(count[k], number, 1)
                np.add.at(sums[k], number, own.astype(sums.dtype))
        slots, limb = np.nonzero(count.ravel())[0], 0
        n, rest = count.ravel()[slots], sums.reshape(parts * entries, width)[slots]
        while len(slots):  # numbers of any size leave as digits that Spark can sum
            if small:
                digit, more = rest, np.zeros(len(slots), bool)
            else:
                digit, rest = rest & (2 ** _LIMB - 1), rest >> _LIMB
                more = np.array([any(v not in (0, -1) for v in r) for r in rest], bool)
                digit = np.where(more[:, None], digit, digit + (rest << _LIMB))
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots), pa.array(np.full(len(slots), limb, np.int64)), pa.array(n if limb == 0 else np.zeros(len(n), np.int64)),
                 *[pa.array(digit[:, i].astype(np.int64)) for i in range(width)]], names=names)
            slots, n, rest, limb = slots[more], n[more], rest[more], limb + 1

    part = rows.select("x").mapInArrow(add, ", ".join(f"{c} long" for c in names))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in part.groupBy("slot", "limb").agg(*[F.sum(c).alias(c) for c in names[2:]]).collect():  # bounded by the codebooks' size
        n, sums = out.get(r["slot"], (0, [0] * width))
        out[r["slot"]] = (n + r["n"], [s + (r[f"s{i}"] << (_LIMB * r["limb"])) for i, s in enumerate(sums)])
    return out


def fit_codebooks(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks | None:
    """Codebooks of ``rows`` (id, x): the parts of the ``entries`` smallest ids, moved ``rounds`` times to the floor of their parts' means.

    Entries that no part is nearest to stay. Rows of equal id come in the order of their vectors, null ids last. None without rows.
    """
    size = rows.agg(F.max(F.size("x")).alias("dim"), F.max(F.array_max(F.transform("x", F.abs))).alias("most")).first()
    if size["dim"] is None:
        return None
    width = -(-size["dim"] // parts)
    small = small_enough(size["most"] or 0.0, width)
    first = rows.select("id", "x").orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()
    start = _matrix(pa.array([r["x"] for r in first], pa.list_(pa.float64())), parts * width, small)
    books = Codebooks([start[:, k * width:(k + 1) * width].copy() for k in range(parts)], small)
    for _ in range(rounds):
        moved = [b.copy() for b in books.books]
        for slot, (n, sums) in _sums(rows, books, parts).items():
            moved[slot // len(first)][slot % len(first)] = [s // n for s in sums]
        books = Codebooks(moved, small)
    return books


def assign_codes(rows: DataFrame, books: Codebooks) -> DataFrame:
    """``rows`` (id, label, x) as id, label, code (binary, a byte a part), error (squared distances summed, at most the largest long)."""
    parts, width, small = len(books.books), books.width, books.small
    sent = rows.sparkSession.sparkContext.broadcast(books.books)

    def assign(batches):
        trees = [Gnat(b) for b in sent.value]
        for b in tidied(batches):
            x = _matrix(b.column(2), parts * width, small)
            code, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), x.dtype)
            for k, tree in enumerate(trees):
                code[:, k], square = tree.nearest(x[:, k * width:(k + 1) * width])
                error += square
            error = error.astype(np.int64) if small else np.array([min(int(e), LONG_MAX) for e in error], np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error)],
                                             names=["id", "label", "code", "error"])

    schema = rows.select("id", "label").schema.add("code", "binary").add("error", "long")
    return rows.select("id", "label", "x").mapInArrow(assign, schema)


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[DataFrame, Codebooks | None]:
    """Codes of all vectors, and their codebooks: a frame of id, label, code, error (see :func:`assign_codes`).

    Rows whose vector is null or holds a null or non-finite component are left out. Vectors that are shorter than
    the longest, or than a whole number of parts, count as if zeros followed. Repeated rows count each; null ids and
    labels are kept. Without rows there are no codebooks. At most 256 entries.
    """
    prepare(vectors.sparkSession)
    rows = usable(vectors, id_col, vector_col, label_col)
    books = fit_codebooks(rows, parts, entries, rounds)
    if books is None:
        schema = rows.select("id", "label").schema.add("code", "binary").add("error", "long")
        return vectors.sparkSession.createDataFrame([], schema), None
    return assign_codes(rows, books), books


def codes_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """Codes of ``embeddings`` in SQL that compares every part with every entry."""
    sql = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, label, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS e, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r
  FROM embeddings WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
w AS MATERIALIZED (SELECT r, (i - 1) // (len(e) // {parts}) AS part, (i - 1) % (len(e) // {parts}) AS pos, e[i] AS x
  FROM (SELECT r, e, unnest(range(1, len(e) + 1)) AS i FROM v)),
b0 AS MATERIALIZED (SELECT part, r AS entry, pos, x AS y FROM w WHERE r < {entries})"""
    for k in range(rounds + 1):
        sql += f""",
d{k} AS (SELECT r, w.part, entry, sum((x - y) * (x - y)) AS d FROM w JOIN b{k} USING (part, pos) GROUP BY r, w.part, entry),
a{k} AS MATERIALIZED (SELECT r, part, min(d * 256 + entry) % 256 AS entry, min(d) AS d FROM d{k} GROUP BY r, part)"""
        if k < rounds:
            sql += f""",
m{k} AS (SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM w JOIN a{k} USING (r, part) GROUP BY part, entry, pos),
b{k + 1} AS MATERIALIZED (SELECT part, entry, pos, coalesce((s - ((s % n + n) % n)) // n, y) AS y FROM b{k} LEFT JOIN m{k} USING (part, entry, pos))"""
    return sql + f""",
c AS (SELECT r, string_agg(format('{{:02x}}', entry::BIGINT), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY r),
h AS (SELECT sha256(string_agg(y::BIGINT::VARCHAR, ',' ORDER BY part, entry, pos)) AS digest FROM b{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, digest AS codebooks_sha256
FROM v JOIN c USING (r) CROSS JOIN h
"""

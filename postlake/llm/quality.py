"""Quality classifier: a linear-chain conditional random field over the lines of a document.

Every line is good or bad. A line's features are counts of its characters and words, and the same of the lines before and
after it; neighbouring labels are linked. The field is trained in numpy on the lines of labelled documents, which all
carry their document's label, and applied as a column function. A document's quality is the mean of its lines' marginal
probabilities of being good, from the forward-backward recursion, weighted by the lines' lengths; a logistic curve
fitted on the training documents turns it into a probability.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_of, prepare, segment_sums, text_bytes, tidied, tidy

#: The classifier is fitted on at most so many labelled documents, those of the smallest hashes of the id, of which each
#: gives at most SAMPLE_LINES lines (of a longer one, evenly spaced runs of RUN lines).
SAMPLE_DOCUMENTS = 4000
SAMPLE_LINES = 512
#: All of them together give at most so many lines (50 numbers each on the driver): long documents then give fewer each.
SAMPLE_TOTAL = 250_000
RUN = 32
STEPS = 300
THRESHOLD = 0.7

_CLASS = np.zeros(256, np.uint8)  # 0: control and symbols
_CLASS[[32, 9, 10, 11, 12, 13]] = 1
_CLASS[97:123] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[[33, 34, 39, 40, 41, 44, 45, 46, 58, 59, 63]] = 5
_CLASS[128:] = 6
OWN = 16


def line_features(lines: pa.Array) -> np.ndarray:
    """OWN numbers of each line; sizes on a log scale, counts as shares, so that they stay between 0 and about 1."""
    raw, off = text_bytes(lines)
    n = np.diff(off)
    size = np.maximum(n, 1)
    kind = _CLASS[raw]
    share = [segment_sums(kind == k, off) for k in range(7)]
    letters = np.maximum(share[2] + share[3] + share[6], 1)
    twin = np.zeros(len(raw), bool)
    twin[1:] = (raw[1:] == raw[:-1]) & ((kind[1:] == 0) | (kind[1:] == 5))
    doubled = segment_sums(twin, off)
    lists = pc.ascii_split_whitespace(lines.cast(pa.large_string()).fill_null(""))
    words = lists.flatten()
    bounds = np.asarray(lists.offsets, np.int64)
    bounds = bounds - bounds[0]
    code = words.dictionary_encode().indices.to_numpy(zero_copy_only=False)
    filled = pc.binary_length(words).to_numpy(zero_copy_only=False) > 0
    line_of = np.repeat(np.arange(len(n)), np.diff(bounds))
    count = np.bincount(line_of[filled], minlength=len(n))
    same = np.zeros(len(code), bool)
    same[1:] = (code[1:] == code[:-1]) & (line_of[1:] == line_of[:-1]) & filled[1:]
    repeats = segment_sums(same, bounds)
    some = np.maximum(count, 1)
    last = np.zeros(len(n), np.uint8)
    first = np.zeros(len(n), np.uint8)
    has = n > 0
    last[has], first[has] = kind[off[1:][has] - 1], kind[off[:-1][has]]
    out = [np.log1p(n) / 8, np.log1p(count) / 6, np.minimum(n / some / 12, 2), share[0] / size, share[3] / letters,
           share[4] / size, share[5] / size, share[1] / size, share[6] / size, doubled / size, repeats / some,
           share[0] / some, repeats > 0.3 * count, last == 5, first == 3, ~has]
    return np.stack([x.astype(np.float32) for x in out], axis=1)


def with_neighbours(own: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A constant, the line's numbers, and those of the lines before and after (zero at a document's ends)."""
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:], after[:-1] = own[:-1], own[1:]
    real = bounds[:-1][bounds[:-1] < bounds[1:]]
    before[real] = 0
    after[bounds[1:][bounds[:-1] < bounds[1:]] - 1] = 0
    return np.concatenate([np.ones((len(own), 1), np.float32), own, before, after], axis=1)


def features_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines, lengths of the lines in bytes, and the documents' bounds (null: one empty line)."""
    lists = pc.split_pattern(texts.cast(pa.large_string()).fill_null(""), "\n")
    bounds = np.asarray(lists.offsets, np.int64)
    lines = lists.flatten()
    lengths = np.asarray(pc.binary_length(lines), np.int64)
    bounds = bounds - bounds[0]
    return with_neighbours(line_features(lines), bounds), lengths, bounds


def _by_turn(bounds: np.ndarray):
    """Documents by falling number of lines, so that those with a line at each turn come first."""
    n = np.diff(bounds)
    order = np.argsort(-n, kind="stable")
    alive = len(n) - np.searchsorted(n[order][::-1], np.arange(1, (n.max() if len(n) else 0) + 1))
    return bounds[:-1][order], n[order], alive


def forward_backward(score: np.ndarray, link: np.ndarray, bounds: np.ndarray):
    """Log-odds scores of lines and the 2 x 2 link scores: marginals of 'good', expected links (2 x 2), log-partition."""
    unary = np.stack([np.zeros_like(score), score], axis=1).astype(np.float64)
    first, n, alive = _by_turn(bounds)
    weight = np.exp(link)
    forward = np.zeros_like(unary)  # probabilities, each line's scaled to sum 1
    scale = np.zeros(len(score))
    top = unary.max(axis=1)
    local = np.exp(unary - top[:, None])
    total = 0.0
    for t, m in enumerate(alive):
        at = first[:m] + t
        f = local[at] if t == 0 else local[at] * (forward[at - 1] @ weight)
        scale[at] = f.sum(axis=1)
        forward[at] = f / scale[at][:, None]
        total += np.log(scale[at]).sum() + top[at].sum()
    backward = np.ones_like(unary)
    links = np.zeros((2, 2))
    for t in range(len(alive) - 1, 0, -1):
        at = first[:alive[t]] + t
        b = local[at] * backward[at] / scale[at][:, None]
        backward[at - 1] = b @ weight.T
        links += weight * (forward[at - 1].T @ b)
    return (forward * backward)[:, 1], links, total


def train(x: np.ndarray, bounds: np.ndarray, good: np.ndarray, steps: int = STEPS, ridge: float = 1e-4) -> dict:
    """Maximum likelihood by Adam: weights of the features and of links; ``good`` is the label of each document."""
    label = np.repeat(good.astype(np.float64), np.diff(bounds))
    inner = np.diff(bounds).astype(np.int64) - 1
    real = np.array([[inner[~good].sum(), 0.0], [0.0, inner[good].sum()]])
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n = max(1, len(label))
    x64 = x.astype(np.float64)
    for step in range(1, steps + 1):
        p, links, _ = forward_backward(x64 @ theta[:-4], theta[-4:].reshape(2, 2), bounds)
        grad = np.concatenate([x64.T @ (p - label), (links - real).ravel()]) / n + ridge * theta
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad ** 2
        theta -= 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    model = {"weights": theta[:-4], "links": theta[-4:].reshape(2, 2), "curve": (0.0, 1.0)}
    return model


def _logit(q: np.ndarray) -> np.ndarray:
    return np.log(np.clip(q, 1e-6, 1 - 1e-6) / np.clip(1 - q, 1e-6, 1 - 1e-6))


def fit_curve(quality: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Offset and slope of the logistic curve from a document's quality (log-odds) to its label, by Newton steps."""
    z = np.stack([np.ones(len(quality)), _logit(quality)], axis=1)
    c = np.array([0.0, 1.0])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ c, -30, 30)))
        h = (z * (p * (1 - p))[:, None]).T @ z + 1e-2 * np.eye(2)
        c = c - np.linalg.solve(h, z.T @ (p - good) + 1e-2 * (c - [0.0, 1.0]))
    return float(c[0]), float(max(c[1], 1e-3))


def document_quality(x: np.ndarray, lengths: np.ndarray, bounds: np.ndarray, model: dict) -> np.ndarray:
    """Length-weighted mean of the lines' marginals; a line weighs one more than its bytes, so that empty ones count."""
    p, _, _ = forward_backward(x @ model["weights"], model["links"], bounds)
    return np.add.reduceat(p * (lengths + 1), bounds[:-1]) / np.add.reduceat(lengths + 1.0, bounds[:-1]) if len(bounds) > 1 else np.zeros(0)


def score_texts(texts: pa.Array, model: dict) -> np.ndarray:
    out = [np.zeros(0)]
    for lo in range(0, len(texts), 200):  # few texts at a time: every byte needs about twenty in the arrays
        x, lengths, bounds = features_of(texts.slice(lo, 200))
        a, b = model["curve"]
        out.append(1 / (1 + np.exp(-(a + b * _logit(document_quality(x, lengths, bounds, model))))))
    return np.concatenate(out)


def lines_each(counts: list[int], total: int) -> int:
    """Lines that each document may give, in whole runs: SAMPLE_LINES, or fewer so that all give at most ``total``."""
    most = SAMPLE_LINES
    while most > RUN and sum(min(n, most) for n in counts) > total:
        most -= RUN
    return most


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
        held_out: Column | None = None, sample: int = SAMPLE_DOCUMENTS, total: int = SAMPLE_TOTAL) -> dict:
    """Train on at most ``sample`` labelled documents for which ``held_out`` is false; without any, every score is 0.5.

    The driver gets at most ``total`` lines of them (but RUN of each document).

    An id with several labels counts by its smallest one; null labels and ids are left out, null texts are empty.
    """
    prepare(docs.sparkSession)
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label")).where("id is not null and label is not null")
    named = named.groupBy("id").agg(F.min("label").alias("label"))
    allowed = docs if held_out is None else docs.where(~held_out)
    # the sample is chosen among ids; only its texts are read on
    ids = allowed.select(F.col(id_col).alias("id")).join(named, "id").distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(sample)
    known = allowed.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(chosen), "id")

    # the longest of them (an id's repeated rows are rows of their own), so that the bound holds whichever are taken
    lines = known.select(F.size(F.split("text", "\n", -1)).alias("lines")).orderBy(F.desc("lines")).limit(sample).collect()
    most = lines_each([r["lines"] or 1 for r in lines], total)

    def numbers(batches):
        for b in tidied(batches):
            for lo in range(0, b.num_rows, 100):
                part = b.slice(lo, 100)
                x, lengths, bounds = features_of(part.column(part.schema.names.index("text")))
                label = part.column(part.schema.names.index("label")).to_pylist()
                ids = part.column(part.schema.names.index("id")).to_pylist()
                for k in range(part.num_rows):
                    own, n = slice(bounds[k], bounds[k + 1]), int(bounds[k + 1] - bounds[k])
                    keep = np.arange(n)
                    if n > most:
                        begin = np.linspace(0, n - RUN, most // RUN).astype(int)
                        keep = np.unique((begin[:, None] + np.arange(RUN)).ravel())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[k]], pa.int64()), pa.array([int(label[k] == 1)], pa.int32()),
                         pa.array([x[own][keep].astype("<f4").tobytes()], pa.binary()), pa.array([lengths[own][keep].astype("<i8").tobytes()], pa.binary())],
                        names=["id", "good", "x", "lengths"])

    rows = known.mapInArrow(numbers, "id long, good int, x binary, lengths binary") \
        .orderBy(F.xxhash64("id"), "id", F.xxhash64("x")).limit(sample).collect()
    if not rows:
        return {"weights": np.zeros(1 + 3 * OWN), "links": np.zeros((2, 2)), "curve": (0.0, 1e-3)}
    x = [np.frombuffer(r.x, "<f4").reshape(-1, 1 + 3 * OWN) for r in rows]
    lengths = np.concatenate([np.frombuffer(r.lengths, "<i8") for r in rows])
    good = np.array([r.good for r in rows], bool)
    bounds = np.concatenate([[0], np.cumsum([len(p) for p in x])])
    x = np.concatenate(x)
    model = train(x, bounds, good)
    model["curve"] = fit_curve(document_quality(x, lengths, bounds, model), good)
    return model


def scorer(model: dict):
    """The column function of a fitted model: probability that a text is good (null: as the empty text)."""
    @F.arrow_udf(T.DoubleType())
    def score(texts: pa.Array) -> pa.Array:
        tidy()
        return pa.array(score_texts(texts, model))

    return score


def score_column(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 4, fold: int = 2,
                 **how) -> tuple[Column, Column]:
    """(held out, score) as columns over ``docs``, from a classifier fitted on its rows that are not held out."""
    held = F.coalesce(F.pmod(crc_of(id_col), F.lit(folds)) == fold, F.lit(False))
    model = fit(docs, labels, id_col, text_col, held_out=held, **how)
    return held, scorer(model)(F.col(text_col).cast("string"))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **how) -> DataFrame:
    """Per row of ``docs``: its id, held_out, score, predicted (1 if the score reaches ``threshold``).

    Rows whose crc32(id as text) mod ``folds`` is ``fold`` (a null id counts as not held out) teach no label. Other
    columns are not looked at; :func:`keep_good` keeps them.
    """
    held, score = score_column(docs, labels, id_col, text_col, **how)
    out = docs.select(F.col(id_col), held.alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, **how) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns kept, whatever their names."""
    _, score = score_column(docs, labels, id_col, text_col, **how)
    return docs.where(score >= threshold)

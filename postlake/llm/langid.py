"""Language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of fixed length. Bytes are embedded, convolved with filters of several widths,
max-pooled over the window and classified by softmax. The network is trained in numpy on labelled texts; to apply it,
embedding and filters are folded into one table per filter offset. A text's language is that of the largest mean
probability over all its windows, weighted by their bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import crc_of, prepare, smallest, text_bytes, tidied

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: The network is fitted on at most so many documents of each language (those of the smallest hashes of the id), each of
#: which gives at most SAMPLE_WINDOWS evenly spaced windows.
SAMPLE_DOCUMENTS = 400
SAMPLE_WINDOWS = 4
EPOCHS = 12
RUN_BYTES = 16_384 * WINDOW
UNKNOWN = "und"


def windows_of(raw: np.ndarray, off: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of texts as rows of bytes (the last one of a text filled up with spaces), their text and true length."""
    n = np.diff(off)
    per = -(-n // window)
    text = np.repeat(np.arange(len(n)), per)
    number = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    begin = off[:-1][text] + number * window
    size = np.minimum(off[1:][text] - begin, window)
    padded = np.concatenate([raw, np.full(window, 32, np.uint8)])
    rows = padded[begin[:, None] + np.arange(window)]
    rows[np.arange(window) >= size[:, None]] = 32
    return rows, text, size


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=1, keepdims=True))


def train(rows: np.ndarray, label: np.ndarray, classes: int, epochs: int = EPOCHS, seed: int = 42) -> dict:
    """Fit embedding, filters and softmax layer by Adam on batches of windows (uint8 rows) with class numbers."""
    rng = np.random.default_rng(seed)
    p = {"e": rng.normal(0, 0.5, (256, EMBEDDING))}
    for w in WIDTHS:
        p[f"k{w}"] = rng.normal(0, (w * EMBEDDING) ** -0.5, (w * EMBEDDING, FILTERS))
    p["b"], p["o"], p["c"] = np.zeros(FILTERS * len(WIDTHS)), rng.normal(0, 0.1, (FILTERS * len(WIDTHS), classes)), np.zeros(classes)
    m, v, turn = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), 64):
            at = order[lo:lo + 64]
            x, n = rows[at], len(at)
            emb = p["e"][x]
            pooled, place = [], []
            for w in WIDTHS:
                seen = np.lib.stride_tricks.sliding_window_view(emb, w, axis=1).transpose(0, 1, 3, 2).reshape(n, x.shape[1] - w + 1, -1)
                out = seen @ p[f"k{w}"]
                best = out.argmax(axis=1)
                pooled.append(np.take_along_axis(out, best[:, None], axis=1)[:, 0])
                place.append(best)
            hidden = np.concatenate(pooled, axis=1) + p["b"]
            act = np.maximum(hidden, 0)
            prob = np.exp(_log_softmax(act @ p["o"] + p["c"]))
            prob[np.arange(n), label[at]] -= 1
            delta = prob / n
            g = {"o": act.T @ delta + 1e-4 * p["o"], "c": delta.sum(axis=0)}
            back = (delta @ p["o"].T) * (hidden > 0)
            g["b"], g["e"] = back.sum(axis=0), np.zeros_like(p["e"])
            for k, w in enumerate(WIDTHS):
                d = back[:, k * FILTERS:(k + 1) * FILTERS]
                byte = x[np.arange(n)[:, None, None], place[k][:, :, None] + np.arange(w)]  # window, filter, offset
                vec = p["e"][byte]
                g[f"k{w}"] = np.einsum("nf,nfwe->wef", d, vec).reshape(w * EMBEDDING, FILTERS)
                part = np.einsum("nf,wef->nfwe", d, p[f"k{w}"].reshape(w, EMBEDDING, FILTERS))
                np.add.at(g["e"], byte.ravel(), part.reshape(-1, EMBEDDING))
            turn += 1
            for k in p:
                m[k] = 0.9 * m[k] + 0.1 * g[k]
                v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] = p[k] - 0.005 * (m[k] / (1 - 0.9 ** turn)) / (np.sqrt(v[k] / (1 - 0.999 ** turn)) + 1e-8)
    tables = []
    for k, w in enumerate(WIDTHS):
        folded = [(p["e"] @ p[f"k{w}"].reshape(w, EMBEDDING, FILTERS)[o]).astype(np.float32) for o in range(w)]
        folded[0] += p["b"][k * FILTERS:(k + 1) * FILTERS].astype(np.float32)
        tables.append(folded)
    return {"tables": tables, "out": p["o"].astype(np.float32), "bias": p["c"].astype(np.float32)}


def probabilities(rows: np.ndarray, model: dict, step: int = 64) -> np.ndarray:
    """Class probabilities of windows, a few windows at a time so that all intermediate values stay in the cache."""
    parts = []
    for lo in range(0, len(rows), step):
        x = rows[lo:lo + step]
        pooled = []
        for tables in model["tables"]:
            n = x.shape[1] - len(tables) + 1
            out = tables[0].take(x[:, :n], axis=0)
            for o in range(1, len(tables)):
                out += tables[o].take(x[:, o:o + n], axis=0)
            pooled.append(out.max(axis=1))
        act = np.maximum(np.concatenate(pooled, axis=1), 0)
        parts.append(np.exp(_log_softmax(act @ model["out"] + model["bias"])))
    return np.concatenate(parts) if parts else np.zeros((0, len(model["bias"])), np.float32)


def classify(texts: pa.Array, model: dict) -> tuple[list, np.ndarray]:
    """Language and score of each text; ``und`` and 0 for nulls and texts without bytes."""
    names, score = [], []
    for lo in range(0, len(texts), 500):
        raw, off = text_bytes(texts.slice(lo, 500))
        n = len(off) - 1
        total = np.zeros((n, len(model["langs"])))
        first = 0
        while first < n:  # runs of texts of up to RUN_BYTES; a longer text is cut between windows
            last = max(first + 1, int(np.searchsorted(off, off[first] + RUN_BYTES, "right")) - 1)
            for at in range(int(off[first]), max(int(off[last]), int(off[first]) + 1), RUN_BYTES):
                cuts = off[first:last + 1] if off[last] - off[first] <= RUN_BYTES else np.array([at, min(int(off[last]), at + RUN_BYTES)])
                rows, text, size = windows_of(raw[cuts[0]:cuts[-1]], cuts - cuts[0])
                np.add.at(total, first + text, probabilities(rows, model) * size[:, None])
            first = last
        size = np.diff(off)
        names += [model["langs"][b] if f else UNKNOWN for b, f in zip(total.argmax(axis=1), size > 0)]
        score.append(np.where(size > 0, np.clip(total.max(axis=1) / np.maximum(size, 1), 0, 1), 0.0))
    return names, np.concatenate(score) if score else np.zeros(0)


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", held_out: Column | None = None,
        sample: int = SAMPLE_DOCUMENTS) -> dict:
    """Train on at most ``sample`` documents of each language for which ``held_out`` is false.

    Null languages and texts without a letter teach nothing. Of rows that share id and language, the text of the
    smallest hash teaches. Without any left, every text is ``und``.
    """
    prepare(docs.sparkSession)
    allowed = docs if held_out is None else docs.where(~held_out)
    allowed = allowed.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    allowed = allowed.where("lang is not null and id is not null").where(F.col("text").rlike(r"\p{L}")).withColumn("hash", F.xxhash64("text"))
    ids = allowed.groupBy("id", "lang").agg(F.min("hash").alias("hash"))
    chosen = smallest(ids, "lang", [F.xxhash64("id"), "id"], sample)  # `sample` rows for each language at most
    known = allowed.join(F.broadcast(chosen), ["id", "lang", "hash"])

    def some_windows(batches):
        for b in tidied(batches):
            ids, texts, langs = (b.column(b.schema.names.index(c)) for c in ("id", "text", "lang"))
            for k in range(b.num_rows):
                rows, _, size = windows_of(*text_bytes(texts.slice(k, 1)))
                keep = np.unique(np.linspace(0, len(rows) - 1, SAMPLE_WINDOWS).astype(int))
                yield pa.RecordBatch.from_arrays([ids.slice(k, 1).cast(pa.int64()), langs.slice(k, 1).cast(pa.string()),
                                                  pa.array([rows[keep].tobytes()], pa.binary())], names=["id", "lang", "rows"])

    taught = known.select("id", "lang", "text").mapInArrow(some_windows, "id long, lang string, rows binary")
    taught = taught.groupBy("id", "lang").agg(F.min("rows").alias("rows"))  # equal rows once
    rows = taught.orderBy("lang", F.xxhash64("id"), "id", "rows").collect()
    if not rows:
        return {"langs": [], "tables": [], "out": np.zeros((0, 0), np.float32), "bias": np.zeros(0, np.float32)}
    langs = sorted({r.lang for r in rows})
    parts = [np.frombuffer(r.rows, np.uint8).reshape(-1, WINDOW) for r in rows]
    label = np.repeat([langs.index(r.lang) for r in rows], [len(p) for p in parts])
    return {"langs": langs} | train(np.concatenate(parts), label, len(langs))


def predict_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, fold: int = 0,
                     **how) -> DataFrame:
    """Per row of ``docs``: its id, held_out, lang_pred, score.

    Rows whose crc32(id as text) mod ``folds`` is ``fold`` (a null id counts as not held out) teach nothing. A null
    text, or one without a letter, is ``und`` with score 0; so is every text if nothing was learned.
    """
    held = F.coalesce(F.pmod(crc_of(id_col), F.lit(folds)) == fold, F.lit(False))
    model = fit(docs, id_col, text_col, lang_col, held, **how)

    @F.arrow_udf(T.StructType([T.StructField("lang", T.StringType()), T.StructField("score", T.DoubleType())]))
    def language(texts: pa.Array) -> pa.Array:
        if not model["langs"]:
            names, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        else:
            names, score = classify(texts, model)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(score, pa.float64())], names=["lang", "score"])

    text = F.col(text_col).cast("string")
    out = docs.select(F.col(id_col), held.alias("held_out"), language(F.when(text.rlike(r"\p{L}"), text)).alias("found"))
    return out.select(out[0], "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"))

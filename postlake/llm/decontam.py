"""Benchmark decontamination by the q-gram lemma and banded alignment.

Texts are compared as UTF-8 bytes, A-Z lower-cased, runs of ASCII white space as one space. A benchmark item is cut into
windows of ``window`` bytes, STRIDE bytes apart (a shorter item is one window), each with a budget of e edits, RATE of its
bytes, rounded up. If a window lies in a document within e edits, the two share at least L + 1 - q (e + 1) q-grams, in one band of
diagonals. So the shared q-grams of each item are counted in overlapping diagonal bands, bands that reach the bound of one
of the item's windows are kept, and the windows that reach their own bound there are aligned within the band.

What is always found: every window within its budget (5 edits in 60 bytes), and so every verbatim passage of at least 60
normalised bytes of an item, wherever it begins: the nearest window lacks at most STRIDE / 2 = 5 of its bytes, which its
budget covers. Shorter passages of longer items are found or not by their place.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, prepare, text_bytes, tidied

Q = 8
WINDOW = 60
#: Bytes from one window of an item to the next.
STRIDE = 10
#: Edits allowed for each byte of a window.
RATE = 0.08
#: Items shorter than this (in normalised bytes) occur by chance and are not searched.
LEAST_CHARS = 20
#: Benchmark bytes that are indexed and broadcast at a time, and document bytes that are compared at a time.
BENCHMARK_BLOCK = 4_000_000
DOCUMENT_BLOCK = 500_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LOWER[[9, 10, 11, 12, 13]] = 32
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_SLOT_BITS = 22


def normalise(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes of texts joined by byte 0, each byte's position in ``raw``, and the texts' offsets."""
    low = _LOWER[raw]
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 32) | (low[:-1] != 32)
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    keep[first] = True
    at = np.nonzero(keep)[0]
    ends = np.searchsorted(at, offsets[1:])
    return np.insert(low[at], ends, 0), np.insert(at, ends, offsets[1:]), np.concatenate([[0], ends + 1 + np.arange(len(ends))])


def grams(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position, as one integer each."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    data = np.ascontiguousarray(data)
    return np.ndarray((len(data) - Q + 1,), "<u8", data, strides=(1,)).copy()


def budget(length: int, rate: float = RATE) -> int:
    """Edits allowed in a window: the rate, rounded up, but so that the q-gram bound stays above zero."""
    return min(math.ceil(rate * length), (length - 1) // Q - 1 if length >= 2 * Q else 0)


def bound(length: int, rate: float = RATE) -> int:
    return length + 1 - Q * (budget(length, rate) + 1)


def item_windows(length: int, window: int = WINDOW) -> list[tuple[int, int]]:
    if length <= window:
        return [(0, length)]
    starts = sorted({*range(0, length - window + 1, STRIDE), length - window})
    return [(s, s + window) for s in starts]


class Index:
    """The q-grams of a block of benchmark items, to find where documents hold windows of them."""

    def __init__(self, items: list[tuple], rate: float = RATE, window: int = WINDOW, least: int = LEAST_CHARS):
        self.rate = rate
        self.items, self.texts, self.windows = [], [], []
        for item, text in items:
            raw, off = text_bytes(pa.array([text], pa.string()))
            data = normalise(raw, off)[0][:-1]
            data = data[int(len(data) and data[0] == 32):len(data) - int(len(data) > 1 and data[-1] == 32)]
            if len(data) >= max(least, Q):
                self.items.append(item)
                self.texts.append(data)
                self.windows.append(item_windows(len(data), window))
        lengths = [len(t) for t in self.texts]
        all_grams = np.concatenate([grams(t) for t in self.texts]) if self.texts else np.zeros(0, np.uint64)
        item = np.repeat(np.arange(len(lengths)), [n - Q + 1 for n in lengths])
        place = np.concatenate([np.arange(n - Q + 1) for n in lengths]) if lengths else item
        order = np.argsort(all_grams, kind="stable")
        self.gram, first = np.unique(all_grams[order], return_index=True)
        self.first = np.append(first, len(order))
        self.item, self.place = item[order], place[order]
        self.slots = np.zeros(1 << _SLOT_BITS, bool)
        self.slots[self._slot(self.gram)] = True
        self.edits = max((budget(b - a, rate) for w in self.windows for a, b in w), default=0)
        self.step = max(16, self.edits + 1)  # bands of two steps, one step apart: any path of `edits` edits is inside one
        self.least = np.array([min(bound(b - a, rate) for a, b in w) for w in self.windows] or [1])
        self.longest = max(lengths, default=0)
        # all windows, item by item, and how many q-grams each must share
        self.first_window = np.concatenate([[0], np.cumsum([len(w) for w in self.windows])]).astype(np.int64)
        self.begin, self.end = (np.array([x[k] for w in self.windows for x in w], np.int64) for k in (0, 1))
        self.needs = np.array([bound(b - a, rate) for w in self.windows for a, b in w], np.int64)

    @staticmethod
    def _slot(g: np.ndarray) -> np.ndarray:
        return (g * _MULTIPLIER) >> np.uint64(64 - _SLOT_BITS)

    def bands(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, first diagonal) where a window shares enough q-grams with a band of diagonals of ``data``."""
        g = grams(data)
        at = np.nonzero(self.slots[self._slot(g)])[0]
        n = np.searchsorted(self.gram, g[at])
        n[n == len(self.gram)] = 0
        real = self.gram[n] == g[at] if len(self.gram) else np.zeros(0, bool)
        at, n = at[real], n[real]
        times = self.first[n + 1] - self.first[n]
        ends = np.cumsum(times)
        entry = np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.first[n] - (ends - times), times)
        cell = (np.repeat(at, times) - self.place[entry] + self.longest) // self.step
        width = (len(data) + self.longest) // self.step + 2
        shared = self.item[entry] * width + cell
        key, count = np.unique(shared, return_counts=True)
        # band k has the cells k and k + 1: look at each cell as the first and as the second of one
        nxt = np.zeros(len(key), np.int64)
        nxt[:-1][key[1:] == key[:-1] + 1] = count[1:][key[1:] == key[:-1] + 1]
        before = np.zeros(len(key), np.int64)
        before[1:][key[1:] == key[:-1] + 1] = 1
        first = key[count + nxt >= self.least[key // width]]
        second = key[(before == 0) & (count >= self.least[key // width])] - 1
        found = np.unique(np.concatenate([first, second]))
        item, cell = np.divmod(found, width)
        # in these bands, of each window the q-grams that lie inside it
        windows = self.first_window[item + 1] - self.first_window[item]
        stop = np.cumsum(windows)
        window = np.arange(int(stop[-1]) if len(stop) else 0) + np.repeat(self.first_window[item] - (stop - windows), windows)
        span, band = self.longest + 1, np.repeat(found, windows)
        places = np.sort(shared * span + self.place[entry])
        upto = lambda cells, place: np.searchsorted(places, cells * span + place)
        a, b = self.begin[window], self.end[window] - Q + 1
        inside = sum(upto(c, b) - upto(c, a) for c in (band, band + 1))
        good = inside >= self.needs[window]
        return window[good], np.repeat(cell * self.step - self.longest, windows)[good]

    def align(self, data: np.ndarray, window: np.ndarray, diagonal: np.ndarray):
        """(item, window's start and end, end in data, edits) of the windows within their budget in the bands."""
        item = np.searchsorted(self.first_window, window, "right") - 1
        jobs: dict[int, list] = {}
        for i, w, d in zip(item.tolist(), window.tolist(), diagonal.tolist()):
            a, b = int(self.begin[w]), int(self.end[w])
            jobs.setdefault(b - a, []).append((i, a, b, d))
        for length, todo in jobs.items():
            for lo in range(0, len(todo), 512):
                yield from self._align(data, todo[lo:lo + 512], length)

    def _align(self, data, todo, length):
        e = budget(length, self.rate)
        width = 2 * self.step + 2 * e
        pattern = np.stack([self.texts[i][a:b] for i, a, b, _ in todo])
        begin = np.array([d + a - e for _, a, _, d in todo])
        col = begin[:, None] + np.arange(width + length)
        text = np.where((col >= 0) & (col < len(data)), data[np.clip(col, 0, max(0, len(data) - 1))] if len(data) else 0, 0)
        step = np.arange(width, dtype=np.int16)
        cost = np.zeros((len(todo), width), np.int16)
        for r in range(length):  # cell d of row r stands for the text before position begin + r + d
            miss = text[:, r:r + width] != pattern[:, r:r + 1]
            new = cost + miss
            new[:, :-1] = np.minimum(new[:, :-1], cost[:, 1:] + 1)
            cost = np.minimum.accumulate(new - step, axis=1) + step
        best = cost.argmin(axis=1)
        edits = cost[np.arange(len(todo)), best]
        for k in np.nonzero(edits <= e)[0].tolist():
            i, a, b, _ = todo[k]
            yield i, a, b, int(begin[k]) + length + int(best[k]), int(edits[k])


def _pieces(texts: pa.Array, size: int, overlap: int):
    """(first text, data, at, starts) of runs of whole texts of about ``size`` bytes, normalised.

    A longer text is normalised piece by piece, each piece after the last ``overlap`` normalised bytes of the one before,
    so that white space at a cut, however much, takes nothing from the overlap. ``at``: places in the bytes of all texts.
    """
    raw, off = text_bytes(texts)
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + size, "right")) - 1)
        if hi == lo + 1 and off[hi] - off[lo] > size:
            data, at, blank = np.zeros(0, np.uint8), np.zeros(0, np.int64), False
            for begin in range(int(off[lo]), int(off[hi]), size):
                low = _LOWER[raw[begin:min(begin + size, int(off[hi]))]]
                keep = low != 32
                keep[1:] |= low[:-1] != 32
                keep[0] |= not blank
                blank = low[-1] == 32
                data, at = np.concatenate([data[-overlap:], low[keep]]), np.concatenate([at[-overlap:], np.nonzero(keep)[0] + begin])
                yield lo, np.append(data, np.uint8(0)), np.append(at, off[hi]), np.array([0, len(data) + 1])
        else:
            data, at, starts = normalise(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            yield lo, data, at + off[lo], starts
        lo = hi


def find_in_texts(index: Index, texts: pa.Array, size: int = DOCUMENT_BLOCK):
    """{(text number, item number): [start, end, edits, windows]} with positions as bytes of the text."""
    found: dict = {}
    if not len(index.texts):
        return found
    _, off = text_bytes(texts)
    overlap = 4 * (max(b - a for w in index.windows for a, b in w) + 2 * index.step)
    for first, data, at, starts in _pieces(texts, size, overlap):
        window, diagonal = index.bands(data)
        for i, a, b, end, edits in index.align(data, window, diagonal):
            end = min(max(end, 1), len(data))
            k = int(np.searchsorted(starts, end - 1, "right")) - 1
            begin = max(int(starts[k]), end - (b - a))
            span = [int(at[begin] - off[first + k]), int(at[end - 1] - off[first + k]) + 1]
            old = found.setdefault((first + k, i), [*span, edits, set()])
            old[0], old[1], old[2] = min(old[0], span[0]), max(old[1], span[1]), min(old[2], edits)
            old[3].add(a)
    return found


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("item_id", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("edits", T.IntegerType()), T.StructField("windows", T.IntegerType())])


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text: str = "text", rate: float = RATE, window: int = WINDOW, least: int = LEAST_CHARS) -> DataFrame:
    """One row per document and benchmark item of which it holds a window: doc_id, item_id, start, end, edits, windows.

    ``start`` and ``end`` are code points of the text, from the first to the last found window (a window's start is
    taken its length before its end); ``edits`` are those of the best window, ``windows`` how many were found. Null
    texts and items are empty; items of fewer than ``least`` normalised bytes are not searched. Repeated documents
    give rows each. The benchmark is read in blocks of about ``BENCHMARK_BLOCK`` bytes, each of which is compared with
    all documents; texts are compared whole, in overlapping pieces of ``DOCUMENT_BLOCK`` bytes.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    out = None
    for sent in _blocks(benchmark, item_col, item_text):

        def search(batches, sent=sent):
            index = Index(sent.value, rate, window, least)
            for b in tidied(batches):
                texts = b.column(1)
                found = sorted(find_in_texts(index, texts).items())
                if not found:
                    continue
                ids = b.column(0)
                part = []
                for (k, i), (start, end, edits, windows) in found:
                    data = texts[k].as_py().encode()
                    point = lambda n: len(data[:n].decode("utf-8", "ignore"))
                    part.append((ids[k].as_py(), index.items[i], point(start), point(end), edits, len(windows)))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part), (
                    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=SCHEMA.names)

        one = rows.mapInArrow(search, SCHEMA)
        out = one if out is None else out.union(one)
    return out.withColumnRenamed("doc_id", id_col)


def _blocks(benchmark: DataFrame, item_col: str, item_text: str) -> list:
    """The benchmark's items, broadcast in blocks of about ``BENCHMARK_BLOCK`` bytes."""
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text).cast("string").alias("text")).where("text is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // (BENCHMARK_BLOCK // 2)))
    out = []
    for block in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == block)
        out.append(benchmark.sparkSession.sparkContext.broadcast([tuple(r) for r in own.collect()]))
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                      rate: float = RATE, window: int = WINDOW, least: int = LEAST_CHARS) -> DataFrame:
    """The rows of ``docs`` that hold no window of any item, all columns kept, whatever their names.

    Every row is decided by its own text, in the pass that hands it on: ids play no part, nothing is shuffled, joined or
    copied. With several blocks of benchmark, each looks at what the ones before it have left (a written table).
    """
    prepare(docs.sparkSession)
    blocks, place = _blocks(benchmark, item_col, item_text), docs.columns.index(text_col)
    for n, sent in enumerate(blocks):

        def clean(batches, sent=sent):
            index = Index(sent.value, rate, window, least)
            for b in tidied(batches):
                keep = np.ones(b.num_rows, bool)
                keep[[k for k, _ in find_in_texts(index, b.column(place).cast(pa.string()))]] = False
                yield b.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
        if n + 1 < len(blocks):
            docs = materialize(docs, "decontam-left")
    return docs

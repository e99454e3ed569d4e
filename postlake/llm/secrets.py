"""Secret scan: fixed patterns, and formats learned by grammar inference from what the patterns find.

The values that the patterns find are labelled credentials, one kind of format for each pattern. Their strings (over
character classes) form a prefix tree with counts; states whose continuations are statistically compatible are merged
(ALERGIA's test by the Hoeffding bound), which gives a probabilistic automaton for each kind, and one for ordinary long
tokens. All other long tokens are then scored by the likelihood of their format under the automata.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, prepare, smallest, tidied

# Fixed patterns of the base rules: kind, pattern, group of the value, least length of the value. re.ASCII keeps case
# folding to A-Z.
BASE = (
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", re.A, 0, 20),
    ("hex", r"[0-9a-f]+", re.A, 0, 24),
)
KINDS = tuple(k for k, *_ in BASE)
#: Kind of the spans that the automata add; it comes after the base kinds.
LEARNED = "grammar"

CANDIDATE = r"[A-Za-z0-9+/_.=-]{16,}"
#: An automaton is fitted on at most so many distinct strings, those of the smallest hashes, and so many characters of each.
SAMPLE = 500
LONGEST = 256
ALPHA = 0.05
#: Least log-likelihood ratio (nats) of a candidate's format against ordinary tokens, in total and for each character.
LEAST_RATIO = 12.0
LEAST_EACH = 0.35
#: Least log-likelihood for each character under the format itself.
LEAST_FIT = -3.0

# Character classes: a-f, g-z, A-F, G-Z, digits, and each symbol of its own. Each symbol's likelihood is spread evenly
# over the characters of its class.
_CLASS = np.full(256, 255, np.uint8)
for _i, _chars in enumerate(("abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ", "0123456789", "+", "/", "_", ".", "=", "-")):
    for _c in _chars:
        _CLASS[ord(_c)] = _i
SYMBOLS = 11
_SIZES = np.array([6, 20, 6, 20, 10, 1, 1, 1, 1, 1, 1])


def base_spans(text: str) -> list[tuple[int, int, int, int, int]]:
    """(kind number, start, end, value's start, value's end) of the base matches, by kind and start."""
    out = []
    for number, (kind, pattern, flags, group, least) in enumerate(BASE):
        # a run of hex digits that is long enough is a maximal run, and every match of the short pattern is one
        pattern = r"[0-9a-f]{24,}" if kind == "hex" else pattern
        if kind == "access" and "AKIA" not in text:
            continue
        for m in re.finditer(pattern, text, flags):
            if m.end(group) - m.start(group) >= least:
                out.append((number, m.start(), m.end(), m.start(group), m.end(group)))
    return out


def candidate_spans(text: str, taken: list[tuple[int, int]]) -> list[tuple[int, int, bool]]:
    """(start, end, whether no span in ``taken`` touches it) of the long tokens that do not lie inside one of those spans."""
    taken, out, first = sorted(taken), [], 0
    for m in re.finditer(CANDIDATE, text):
        while first < len(taken) and taken[first][1] <= m.start():  # by start: later ones may end before, too
            first += 1
        touched = inside = False
        k = first
        while k < len(taken) and taken[k][0] < m.end():
            touched |= taken[k][1] > m.start()
            inside |= taken[k][0] <= m.start() and taken[k][1] >= m.end()
            k += 1
        if not inside:
            out.append((m.start(), m.end(), not touched))
    return out


class Automaton:
    """A probabilistic automaton: next state and log-probability of each symbol by state, and of ending there."""

    def __init__(self, step: np.ndarray, score: np.ndarray, stop: np.ndarray):
        self.step, self.score, self.stop = step, score, stop

    def log_likelihood(self, raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Of strings given as bytes and offsets; all strings advance together."""
        n = np.diff(off)
        order = np.argsort(-n, kind="stable")
        alive = len(n) - np.searchsorted(n[order][::-1], np.arange(1, (n.max() if len(n) else 0) + 1))
        begin = off[:-1][order]
        state, total = np.zeros(len(n), np.int64), np.zeros(len(n))
        for t, m in enumerate(alive):
            c = _CLASS[raw[begin[:m] + t]]
            total[:m] += self.score[state[:m], c]
            state[:m] = self.step[state[:m], c]
        out = np.empty(len(n))
        out[order] = total + self.stop[state]
        return out


def infer(strings: list[str], alpha: float = ALPHA, longest: int = LONGEST) -> Automaton:
    """Merge the compatible states of the strings' prefix tree, breadth first, into an automaton.

    Of a longer string the first ``longest`` characters teach how formats go on, but not that they end there.
    """
    to: list[dict[int, int]] = [{}]  # next state by symbol, and how often each edge and each end was taken
    taken: list[dict[int, int]] = [{}]
    end = [0]
    for s in strings:
        q = 0
        for c in _CLASS[np.frombuffer(s[:longest].encode(), np.uint8)].tolist():
            if c not in to[q]:
                to[q][c] = len(to)
                to.append({})
                taken.append({})
                end.append(0)
            taken[q][c] = taken[q].get(c, 0) + 1
            q = to[q][c]
        end[q] += len(s) <= longest
    uses = [sum(t.values()) + e for t, e in zip(taken, end)]
    limit = math.sqrt(0.5 * math.log(2 / alpha))

    def differ(f1: int, n1: int, f2: int, n2: int) -> bool:
        return n1 > 0 and n2 > 0 and abs(f1 / n1 - f2 / n2) >= limit * (n1 ** -0.5 + n2 ** -0.5)

    def compatible(a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            if differ(end[a], uses[a], end[b], uses[b]):
                return False
            for c in to[a].keys() | to[b].keys():
                if differ(taken[a].get(c, 0), uses[a], taken[b].get(c, 0), uses[b]):
                    return False
                if c in to[a] and c in to[b]:
                    todo.append((to[a][c], to[b][c]))
        return True

    def fold(a: int, b: int) -> None:
        """Add the state b and the tree below it to the state a."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            end[a] += end[b]
            uses[a] += uses[b]
            for c, y in to[b].items():
                taken[a][c] = taken[a].get(c, 0) + taken[b][c]
                if c in to[a]:
                    todo.append((to[a][c], y))
                else:
                    to[a][c] = y

    # kept states are red; the children of red states that are not red themselves are roots of untouched trees
    red, done = [0], {0}
    while True:
        edge = next(((p, c) for p in red for c in sorted(to[p]) if to[p][c] not in done), None)
        if edge is None:
            break
        p, c = edge
        q = to[p][c]
        for r in red:
            if compatible(r, q):
                to[p][c] = r
                fold(r, q)
                break
        else:
            red.append(q)
            done.add(q)
    number = {q: i for i, q in enumerate(red)}
    step = np.zeros((len(red) + 1, SYMBOLS), np.int64) + len(red)
    score = np.zeros((len(red) + 1, SYMBOLS))
    stop = np.zeros(len(red) + 1)
    for q, i in number.items():
        use = np.zeros(SYMBOLS)
        for c, x in to[q].items():
            use[c] = taken[q][c]
            step[i, c] = number[x]
        total = uses[q] + 0.1 * (SYMBOLS + 1)
        score[i] = np.log((use + 0.1) / total / _SIZES)
        stop[i] = math.log((end[q] + 0.1) / total)
    score[-1] = np.log(1 / (SYMBOLS + 1) / _SIZES)  # off the automaton: any symbol alike
    stop[-1] = math.log(1 / (SYMBOLS + 1))
    return Automaton(step, score, stop)


def learned_formats(strings: dict[str, list[str]], ordinary: list[str]) -> tuple[dict[str, Automaton], Automaton]:
    return {k: infer(v) for k, v in strings.items() if v}, infer(ordinary)


def is_credential(tokens: list[str], formats: dict[str, Automaton], ordinary: Automaton) -> np.ndarray:
    """Whether each token's format is far likelier under one of the credentials' automata than among ordinary tokens."""
    data = "".join(tokens).encode()
    raw, n = np.frombuffer(data, np.uint8), np.array([len(t) for t in tokens], np.int64)
    off = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
    if not formats or not len(tokens):
        return np.zeros(len(tokens), bool)
    best = np.max([a.log_likelihood(raw, off) for a in formats.values()], axis=0)
    ratio = best - ordinary.log_likelihood(raw, off)
    return (ratio >= LEAST_RATIO) & (ratio >= LEAST_EACH * n) & (best >= LEAST_FIT * n)


FOUND = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("base", T.ArrayType(T.LongType())),
    T.StructField("values", T.ArrayType(T.StringType())), T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("apart", T.ArrayType(T.BooleanType()))])


def scan_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One pass over the texts: base matches (five numbers each) with their values, and the other long tokens.

    ``apart`` says of each token that no base match touches it; a token inside a base match is not listed.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def scan(batches):
        names = [f.name for f in FOUND]
        kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.bool_())]
        for b in tidied(batches):
            out = [[], [], [], [], []]
            for text in b.column(1).to_pylist():
                text = text or ""
                base = base_spans(text)
                rest = candidate_spans(text, [x[1:3] for x in base])
                for column, value in zip(out, ([n for x in base for n in x], [text[x[3]:x[4]] for x in base], [a for a, _, _ in rest], [text[a:z] for a, z, _ in rest], [x for _, _, x in rest])):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(out, kinds[1:])]], names=names)

    return rows.mapInArrow(scan, FOUND)


def training_strings(found: DataFrame, sample: int = SAMPLE) -> dict[str, list[str]]:
    """At most ``sample`` distinct strings of each base kind and of the tokens apart from them, by the smallest hashes.

    Strings come whole but for what :func:`infer` does not read: at most LONGEST characters and one more.
    """
    base = found.where(F.size("values") > 0).select(F.explode(F.transform("values", lambda v, i: F.struct(
        F.get("base", i * 5).cast("int").alias("kind"), v.alias("value")))).alias("x")).select("x.kind", "x.value")
    other = found.select(F.lit(len(BASE)).alias("kind"), F.explode(F.filter("tokens", lambda t, i: F.get("apart", i))).alias("value"))
    # a third of all tokens may be one string: distinct() pre-aggregates
    picked = smallest(base.union(other).distinct(), "kind", [F.xxhash64("value"), "value"], sample) \
        .withColumn("value", F.substring("value", 1, LONGEST + 1))
    out: dict[str, list[str]] = {k: [] for k in (*KINDS, LEARNED)}
    for r in picked.orderBy("kind", "value").collect():
        out[(*KINDS, LEARNED)[r.kind]].append(r.value)
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, spans, n_grammar.

    Base spans are whole matches of the three patterns, leftmost and non-overlapping for each kind. The automata add
    spans of kind ``grammar``, of long tokens that do not lie inside one base span; base spans stay. ``spans`` joins
    ``kind:start:end`` by start, then kind, with commas (code points, end exclusive); ``base_sha256`` is the SHA-256 of
    the same of the base spans. A null text is empty: no spans, the digest of the empty string. Without labelled
    credentials nothing is added. Automata learn from at most ``sample`` strings of each kind, of which they read the
    first LONGEST characters; all tokens are scored whole.
    """
    prepare(docs.sparkSession)
    found = materialize(scan_texts(docs, id_col, text_col), "secret-scan")
    strings = training_strings(found, sample)
    formats, ordinary = learned_formats({k: strings[k] for k in KINDS}, strings[LEARNED])

    def judge(batches):
        for b in tidied(batches):
            ids, base, starts, tokens = (b.column(b.schema.names.index(c)) for c in ("id", "base", "starts", "tokens"))
            words = tokens.flatten().dictionary_encode()
            good = is_credential(words.dictionary.to_pylist(), formats, ordinary)
            secret = good[words.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, bool)
            bounds = np.asarray(tokens.offsets, np.int64)
            bounds = bounds - bounds[0]
            hits, where = np.nonzero(secret)[0], starts.flatten().to_numpy(zero_copy_only=False)
            first = np.searchsorted(hits, bounds)
            out = [[] for _ in range(6)]
            for k, numbers in enumerate(base.to_pylist()):
                spans = sorted((numbers[i + 1], numbers[i], numbers[i + 2]) for i in range(0, len(numbers), 5))
                text = [f"{KINDS[kind]}:{a}:{z}" for a, kind, z in spans]
                kinds = [kind for _, kind, _ in spans]
                digest = hashlib.sha256(",".join(text).encode()).hexdigest()
                added = [(int(where[i]), len(KINDS), int(where[i]) + len(words.dictionary[words.indices[i].as_py()].as_py())) for i in hits[first[k]:first[k + 1]]]
                if added:
                    text = [f"{(*KINDS, LEARNED)[kind]}:{a}:{z}" for a, kind, z in sorted(spans + added)]
                for column, value in zip(out, (kinds.count(0), kinds.count(1), kinds.count(2), digest, ",".join(text), len(added))):
                    column.append(value)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([ids, *[pa.array(c, t) for c, t in zip(out, types)]],
                                             names=["id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_grammar"])

    out = found.select("id", "base", "starts", "tokens").mapInArrow(
        judge, "id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_grammar long")
    return out.withColumnRenamed("id", id_col)

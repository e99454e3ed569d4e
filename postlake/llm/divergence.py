"""Source divergence audit: how far each source's words are from those of its language and of every other source.

Gustavson's row-by-row product over a term-major index: the kept terms of a language, each with its postings (source,
count), are cut into slices. In a slice, each source's row walks through its terms' postings and scatters what every
peer adds into one dense accumulator (a number for each peer), so no pair of postings is ever a row; slices' accumulators are
summed. A term that a source lacks still has its zero share: these baselines come from each source's histogram of counts,
and the postings' part corrects them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, prepare, text_bytes, tidied

#: A term is kept if so many documents of its language have it.
LEAST_DOCUMENTS = 10
#: Parts in which shares are counted, and how many occurrences are added to every count.
UNIT, ADDED = 1_000_000_000, 2
#: Ranks of the terms that are reported for a source.
TOP_TERMS = 10
#: Postings in a slice of the index (more, if there are many sources: at least SLICE_ROWS for each).
SLICE, SLICE_ROWS = 4096, 64
#: Bytes of text whose terms are counted at a time, and posting pairs in a scatter step.
PIECE, STEP = 4 << 20, 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_LETTER[128:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _tally(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(document, term, count) of every document's distinct terms: runs of letters and characters above ASCII."""
    letter = _LETTER[raw]
    first, last = letter.copy(), letter.copy()
    first[1:] &= ~letter[:-1]
    last[:-1] &= ~letter[1:]
    inner = off[1:-1][(off[1:-1] > 0) & (off[1:-1] < len(raw))]
    first[inner], last[inner - 1] = letter[inner], letter[inner - 1]
    begin, end = np.nonzero(first)[0], np.nonzero(last)[0] + 1
    data = np.ascontiguousarray(_LOWER[raw[letter]])
    bounds = np.concatenate([[0], np.cumsum(end - begin)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(bounds), pa.py_buffer(data)).dictionary_encode()
    document = np.searchsorted(off, begin, "right") - 1
    key, count = np.unique(document * max(1, len(words.dictionary)) + words.indices.to_numpy(zero_copy_only=False), return_counts=True)
    document, code = np.divmod(key, max(1, len(words.dictionary)))
    return document, words.dictionary.take(pa.array(code)), count


def _merged(terms: pa.Array, count: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    coded = terms.dictionary_encode()
    sums = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(sums, coded.indices.to_numpy(zero_copy_only=False), count)
    return coded.dictionary, sums


def document_terms(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """:func:`_tally` of whole texts, a few megabytes at a time; a longer text is cut between terms and put together."""
    raw, off = text_bytes(texts)
    documents, terms, counts = [np.zeros(0, np.int64)], [pa.array([], pa.large_string())], [np.zeros(0, np.int64)]
    lo = 0
    while lo < len(off) - 1:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + PIECE, "right")) - 1)
        if hi == lo + 1 and off[hi] - off[lo] > PIECE:
            parts, at = [], int(off[lo])
            while at < off[hi]:
                end = min(int(off[hi]), at + PIECE)
                while end < off[hi] and _LETTER[raw[end - 1]] and _LETTER[raw[end]]:
                    end += 1
                parts.append(_tally(raw[at:end], np.array([0, end - at]))[1:])
                at = end
            own, count = _merged(pa.concat_arrays([t for t, _ in parts]), np.concatenate([c for _, c in parts]))
            document = np.full(len(own), lo)
        else:
            document, own, count = _tally(raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
            document = document + lo
        documents.append(document)
        terms.append(own)
        counts.append(count)
        lo = hi
    return np.concatenate(documents), pa.concat_arrays(terms), np.concatenate(counts)


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), docs (documents that have it) of a frame of lang, source, text."""
    def tally(batches):
        for b in tidied(batches):
            langs, sources = (b.column(i).dictionary_encode() for i in (0, 1))
            group = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64) * max(1, len(sources.dictionary)) + sources.indices.to_numpy(zero_copy_only=False)
            document, terms, count = document_terms(b.column(2))
            words = terms.dictionary_encode()
            key, back = np.unique(group[document] * max(1, len(words.dictionary)) + words.indices.to_numpy(zero_copy_only=False), return_inverse=True)
            n = np.zeros(len(key), np.int64)
            np.add.at(n, back, count)
            group, code = np.divmod(key, max(1, len(words.dictionary)))
            lang, source = np.divmod(group, max(1, len(sources.dictionary)))
            yield pa.RecordBatch.from_arrays(
                [langs.dictionary.take(pa.array(lang)).cast(pa.string()), sources.dictionary.take(pa.array(source)).cast(pa.string()),
                 words.dictionary.take(pa.array(code)).cast(pa.string()), pa.array(n), pa.array(np.bincount(back, minlength=len(key)).astype(np.int64))],
                names=["lang", "source", "term", "n", "docs"])

    found = docs.mapInArrow(tally, "lang string, source string, term string, n long, docs long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: np.ndarray, total) -> np.ndarray:
    """1 + floor(UNIT * (count + ADDED) / total), exact for totals up to 9e15: three steps of long division."""
    rest, out = np.asarray(count, np.int64) + ADDED, np.int64(0)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return 1 + out


def gap(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of whole numbers up to about 1e9; the same for (q, p)."""
    return (p - q) ** 2 // (p + q)


class Peers:
    """The sources of a language: names by number, totals (count + what is added), shares of a term that a source lacks."""

    def __init__(self, table: pa.Table):
        table = table.sort_by("sid")
        self.names = table.column("source").combine_chunks()
        self.lang = table.column("lang")[0].as_py()
        self.terms = table.column("vocabulary")[0].as_py()
        self.words = table.column("lang_words")[0].as_py()
        self.total = table.column("words").to_numpy() + ADDED * self.terms
        self.zero = share(np.zeros(len(self.total), np.int64), self.total) if self.terms else self.total

    def rows(self, parts: list[tuple]) -> pa.Table:
        """Result rows of (source numbers, part, items, values)."""
        source = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
        items = pa.concat_arrays([pa.array([], pa.string()), *[p[2].cast(pa.string()) for p in parts]])
        kinds = [p[1] for p in parts for _ in range(len(p[0]))]
        values = np.concatenate([p[3] for p in parts] or [np.zeros(0, np.int64)]).astype(np.int64)
        return pa.table({"lang": pa.array([self.lang] * len(source), pa.string()), "source": self.names.take(pa.array(source)).cast(pa.string()),
                         "part": pa.array(kinds, pa.string()), "item": items, "value": pa.array(values)})


RESULT = "lang string, source string, part string, item string, value long"


def scatter(postings: pa.Table, peers: pa.Table, top: int = TOP_TERMS) -> pa.Table:
    """A slice of the index: what its postings add to each pair of sources, and each source's ``top`` terms."""
    if not len(postings) or not len(peers):
        return pa.table({"lang": pa.array([], pa.string()), "source": pa.array([], pa.string()), "part": pa.array([], pa.string()),
                         "item": pa.array([], pa.string()), "value": pa.array([], pa.int64())})
    lang = Peers(peers)
    coded = postings.column("term").combine_chunks().dictionary_encode()
    term, sid = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), postings.column("sid").to_numpy().astype(np.int64)
    order = np.lexsort((sid, term))  # term-major
    term, sid = term[order], sid[order]
    first = np.searchsorted(term, np.arange(len(coded.dictionary) + 1))
    p = share(postings.column("n").to_numpy()[order], lang.total[sid])
    parts = []
    rows = np.argsort(sid, kind="stable")
    edges = np.searchsorted(sid[rows], np.arange(len(lang.names) + 1))
    for g in np.unique(sid).tolist():
        own = rows[edges[g]:edges[g + 1]]
        sums = np.zeros(len(lang.names), np.int64)
        sizes = first[term[own] + 1] - first[term[own]]
        steps = np.concatenate([[0], np.cumsum(sizes)])
        lo = 0
        while lo < len(own):
            hi = max(lo + 1, int(np.searchsorted(steps, steps[lo] + STEP, "right")) - 1)
            some, size = own[lo:hi], sizes[lo:hi]
            at = np.arange(size.sum()) + np.repeat(first[term[some]] - (np.cumsum(size) - size), size)
            peer, mine, theirs = sid[at], np.repeat(p[some], size), p[at]
            np.add.at(sums, peer, gap(mine, theirs) - gap(mine, lang.zero[peer]) - gap(lang.zero[g], theirs) + gap(lang.zero[g], lang.zero[peer]))
            lo = hi
        sums[g] = 0
        peer = np.nonzero(sums)[0]
        parts.append((np.full(len(peer), g), "pair", lang.names.take(pa.array(peer)), sums[peer]))
    q = share(postings.column("lang_n").to_numpy()[order], lang.words + ADDED * lang.terms)
    above = np.nonzero(p > q)[0]
    value = gap(p[above], q[above])
    rank = np.empty(len(coded.dictionary), np.int64)
    rank[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(rank))
    best = np.lexsort((rank[term[above]], -value, sid[above]))
    above, value = above[best], value[best]
    turn = np.arange(len(above)) - np.searchsorted(sid[above], sid[above])
    above, value = above[turn < top], value[turn < top]
    parts.append((sid[above], "term", coded.dictionary.take(pa.array(term[above])), value))
    return lang.rows(parts)


def baselines(histogram: pa.Table, peers: pa.Table) -> pa.Table:
    """What each source's counts (sid, n, terms; n = 0: the terms that it lacks) add against peers that lack the terms.

    A pair gets the sum of the one source's terms against the other's zero share and that of the other against its own;
    the terms that neither has are in both sums, and one of the two is taken back.
    """
    lang = Peers(peers) if len(peers) else None
    sid = histogram.column("sid").to_numpy().astype(np.int64)
    parts = []
    for g in np.unique(sid).tolist():
        others = np.delete(np.arange(len(lang.names)), g)
        names, own = lang.names.take(pa.array(others)), np.full(len(others), g)
        if not lang.terms:
            parts.append((own, "pair", names, np.zeros(len(others), np.int64)))
            continue
        at = np.nonzero(sid == g)[0]
        p, times = share(histogram.column("n").to_numpy()[at], lang.total[g]), histogram.column("terms").to_numpy()[at]
        sums = np.zeros(len(others), np.int64)
        step = max(1, STEP // max(1, len(others)))
        for lo in range(0, len(at), step):
            sums += (gap(p[lo:lo + step, None], lang.zero[others]) * times[lo:lo + step, None]).sum(axis=0)
        parts.append((own, "pair", names, sums))
        parts.append((others, "pair", lang.names.take(pa.array(own)), sums - lang.terms * gap(lang.zero[g], lang.zero[others])))
    return lang.rows(parts) if lang else scatter(histogram, peers)


def audit_sources(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                  least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """Per (lang, source) group: lang, source, part, item, value, rank.

    Part ``pair`` has each other source of the language as item: the divergence of the two over all kept terms (0
    without kept terms), all ranks. Part ``term`` has the kept terms that the source uses more than its language, the ``top`` of
    them by divergence. Ranks go by falling value, then by item in the order of its UTF-8 bytes. Null languages, sources and texts
    count as empty strings. Terms are runs of ASCII letters and characters above ASCII, A-Z lower-cased; a term is kept in
    a language in which at least ``least`` rows have it. Repeated rows count each; a group without any kept term
    has its pairs, and its language's only source has none.

    All numbers are whole and exact. Texts are counted where they lie, and only sums by (language, source, term) are shuffled. A slice
    of the index is one task's: about SLICE postings, or SLICE_ROWS for each source, whose accumulator is as long as the
    language has sources.
    """
    spark = docs.sparkSession
    prepare(spark)
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"))],
                        F.col(text_col).cast("string").alias("text"))
    term = Window.partitionBy("lang", "term")  # a row for each source that has the term
    counts = count_terms(named).withColumn("lang_docs", F.sum("docs").over(term)).withColumn("lang_n", F.sum("n").over(term)) \
        .withColumn("first", F.row_number().over(term.orderBy("source")) == 1)
    postings = materialize(counts.where(F.col("lang_docs") >= least).select("lang", "source", "term", "n", "lang_n", "first"), "audit-postings")
    langs = postings.groupBy("lang").agg(F.sum("n").alias("lang_words"), F.count_if("first").alias("vocabulary"))
    own = postings.groupBy("lang", "source").agg(F.sum("n").alias("words"), F.count("*").alias("terms"))
    groups = named.select("lang", "source").distinct().join(own, ["lang", "source"], "left").join(langs, "lang", "left").fillna(0)
    groups = materialize(groups.withColumn("sid", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1), "audit-groups")
    sizes = groups.agg(F.count("*").alias("groups"), F.sum("terms").alias("postings")).first()
    slices = max(1, (sizes["postings"] or 0) // max(SLICE, SLICE_ROWS * sizes["groups"]))
    blocks = 1 + sizes["groups"] // 16

    def spread(parts: int) -> DataFrame:
        """All sources of a language for each part of its rows."""
        peers = groups.toDF(*groups.columns)  # columns of its own: the other side has the same table's numbers
        return peers.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))

    numbered = postings.join(groups.select("lang", "source", "sid"), ["lang", "source"])
    sliced = numbered.select("lang", F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int").alias("slice"), "term", "sid", "n", "lang_n")
    found = sliced.groupBy("lang", "slice").cogroup(spread(slices).groupBy("lang", "slice")) \
        .applyInArrow(lambda a, b: scatter(a, b, top), RESULT)
    counted = numbered.groupBy("lang", "sid", "n").agg(F.count("*").alias("terms")) \
        .unionByName(groups.select("lang", "sid", F.lit(0).cast("long").alias("n"), (F.col("vocabulary") - F.col("terms")).alias("terms")))
    counted = counted.withColumn("slice", F.pmod(F.col("sid"), F.lit(blocks)))
    zeros = counted.groupBy("lang", "slice").cogroup(spread(blocks).groupBy("lang", "slice")).applyInArrow(baselines, RESULT)
    parts = materialize(found.unionByName(zeros), "audit-parts")
    pairs = parts.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [p.withColumn("rank", F.row_number().over(best)) for p in (pairs, parts.where("part = 'term'"))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top))


def audit_sql(least: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> str:
    """The same over ``documents``, in SQL that spells out every pair and term."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
  translate(coalesce(text, ''), '{upper}', '{upper.lower()}') AS body FROM documents),
t AS (SELECT lang, source, r, unnest(regexp_extract_all(body, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= {least}),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
f AS MATERIALIZED (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
s AS (SELECT lang, term, sum(n) AS n FROM f GROUP BY lang, term),
p AS MATERIALIZED (SELECT *, 1 + ({UNIT}::HUGEINT * (n + {ADDED})) // (sum(n) OVER (PARTITION BY lang, source) + {ADDED} * count(*) OVER (PARTITION BY lang, source)) AS p FROM f),
q AS MATERIALIZED (SELECT lang, term, 1 + ({UNIT}::HUGEINT * (n + {ADDED})) // (sum(n) OVER (PARTITION BY lang) + {ADDED} * count(*) OVER (PARTITION BY lang)) AS q FROM s),
e AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
    (SELECT coalesce(sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)), 0) FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term
     WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  UNION ALL SELECT p.lang, p.source, 'term', p.term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM e)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {top}
"""

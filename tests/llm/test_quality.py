import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa

from helpers import documents, prose
from postlake.llm import quality as q
from postlake.llm import queries

SF = "/root/testdata/sf0.01"


def brute(score, link, lengths):
    """Marginals and log-partition by listing all labellings of each document."""
    marginals, links, total, at = [], np.zeros((2, 2)), 0.0, 0
    for n in lengths:
        s = score[at:at + n]
        at += n
        weight = {y: np.exp(sum(s[t] * y[t] for t in range(n)) + sum(link[y[t], y[t + 1]] for t in range(n - 1))) for y in itertools.product((0, 1), repeat=n)}
        z = sum(weight.values())
        total += np.log(z)
        marginals += [sum(w for y, w in weight.items() if y[t]) / z for t in range(n)]
        for y, w in weight.items():
            for t in range(n - 1):
                links[y[t], y[t + 1]] += w / z
    return np.array(marginals), links, total


def test_forward_backward():
    rng = np.random.default_rng(0)
    lengths = [3, 1, 5, 2, 1]
    score, link = rng.normal(0, 3, sum(lengths)), rng.normal(0, 2, (2, 2))
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    for got, want in zip(q.forward_backward(score, link, bounds), brute(score, link, lengths)):
        assert np.allclose(got, want)


def test_gradient():
    rng = np.random.default_rng(1)
    lengths, good = [3, 2, 4], np.array([True, False, True])
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    x, theta = rng.normal(0, 1, (9, 2)), rng.normal(0, 1, 6)

    def loss(t):
        y = np.repeat(good.astype(int), lengths)
        s, link = x @ t[:2], t[2:].reshape(2, 2)
        own = (s * y).sum() + sum(link[g, g] * (n - 1) for g, n in zip(good.astype(int), lengths))
        return q.forward_backward(s, link, bounds)[2] - own

    p, links, _ = q.forward_backward(x @ theta[:2], theta[2:].reshape(2, 2), bounds)
    real = np.array([[1.0, 0], [0, 5]])
    grad = np.concatenate([x.T @ (p - np.repeat(good, lengths)), (links - real).ravel()])
    for k in range(6):
        e = np.zeros(6)
        e[k] = 1e-5
        assert abs((loss(theta + e) - loss(theta - e)) / 2e-5 - grad[k]) < 1e-4


def test_features_are_of_the_document():
    texts = pa.array(["a b\nc\n\nTHE THE!!", None, "", "x\n", "é" * 50 + "\n" + "z " * 30_000], pa.string())
    x, lengths, bounds = q.features_of(texts)
    assert bounds.tolist() == [0, 4, 5, 6, 8, 10] and lengths[:4].tolist() == [3, 1, 0, 9]
    for k in range(5):
        own, _, _ = q.features_of(texts.slice(k, 1))
        assert np.array_equal(x[bounds[k]:bounds[k + 1]], own)
    assert np.isfinite(x).all()


KINDS = [lambda c: c < 128 and chr(c) in " \t\n\v\f\r", lambda c: 97 <= c <= 122, lambda c: 65 <= c <= 90, lambda c: 48 <= c <= 57,
         lambda c: c < 128 and chr(c) in "!\"'(),-.:;?", lambda c: c >= 128]


def kind_of(byte):
    return next((k for k, test in enumerate(KINDS, 1) if test(byte)), 0)


def brute_line(line):
    """The sixteen numbers of a line, byte by byte and word by word."""
    raw, words = line.encode(), [w for w in re.split(r"[\x20\x09-\x0D]+", line) if w]
    n, size = len(raw), max(1, len(raw))
    count = [sum(kind_of(b) == k for b in raw) for k in range(7)]
    letters, some = max(1, count[2] + count[3] + count[6]), max(1, len(words))
    doubled = sum(a == b and kind_of(b) in (0, 5) for a, b in zip(raw, raw[1:]))
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    return [np.log1p(n) / 8, np.log1p(len(words)) / 6, min(n / some / 12, 2), count[0] / size, count[3] / letters, count[4] / size, count[5] / size,
            count[1] / size, count[6] / size, doubled / size, repeats / some, count[0] / some, repeats > 0.3 * len(words),
            n > 0 and kind_of(raw[-1]) == 5, n > 0 and kind_of(raw[0]) == 3, n == 0]


def brute_score(text, model):
    """A document's score with plain loops: features, forward-backward in logarithms, weighted mean, curve."""
    lines = (text or "").split("\n")
    own = [brute_line(x) for x in lines]
    zero = [0.0] * 16
    x = [[1.0, *o, *(own[i - 1] if i else zero), *(own[i + 1] if i + 1 < len(own) else zero)] for i, o in enumerate(own)]
    unary = [[0.0, float(np.dot(f, model["weights"]))] for f in x]
    link, add = model["links"], np.logaddexp
    forward = [list(unary[0])]
    for u in unary[1:]:
        forward.append([u[b] + add(forward[-1][0] + link[0, b], forward[-1][1] + link[1, b]) for b in (0, 1)])
    backward = [[0.0, 0.0]]
    for u in reversed(unary[1:]):
        backward.insert(0, [add(link[a, 0] + u[0] + backward[0][0], link[a, 1] + u[1] + backward[0][1]) for a in (0, 1)])
    total = add(*forward[-1])
    good = [np.exp(f[1] + b[1] - total) for f, b in zip(forward, backward)]
    weight = [len(line.encode()) + 1 for line in lines]
    q = float(np.clip(np.dot(good, weight) / sum(weight), 1e-6, 1 - 1e-6))
    a, b = model["curve"]
    return 1 / (1 + np.exp(-(a + b * np.log(q / (1 - q)))))


def test_query_scores_as_brute_force(spark):
    """Every score of the query, from the model fitted on the same rows, by plain loops over whole texts."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = q.F.pmod(q.crc_of("doc_id"), q.F.lit(4)) == 2
    model = q.fit(docs, labels, held_out=held)
    got = {r.doc_id: r.score for r in queries.op6_quality(spark, SF).collect()}
    rows = docs.collect()
    assert len(rows) == len(got)
    for r in rows:
        assert abs(got[r.doc_id] - brute_score(r.text, model)) < 1e-3, r.doc_id
    for text in ("", None, "\n\n", "A b.\nA b.\n### ###", "É é\tÀ \v x", "x" * 500):
        assert abs(q.score_texts(pa.array([text], pa.string()), model)[0] - brute_score(text, model)) < 1e-3


def test_driver_gets_a_bounded_number_of_lines(spark):
    assert q.lines_each([10] * 4000, 250_000) == q.SAMPLE_LINES and q.lines_each([10 ** 6] * 4000, 250_000) <= 64
    for counts in ([600] * 700, [10 ** 5] * 3 + [5] * 3000):
        most = q.lines_each(counts, 100_000)
        assert sum(min(n, most) for n in counts) <= 100_000 and most % q.RUN == 0
    rows = [(i, "\n".join(f"line {k} of {i}" for k in range(900))) for i in range(40)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    seen = []
    train = q.train
    q.train = lambda x, *a, **k: seen.append(len(x)) or train(x, *a, **k)
    try:
        q.fit(documents(spark, rows), labels, total=4000)
    finally:
        q.train = train
    assert 0 < seen[0] <= 4000


def test_held_out_accuracy(spark):
    got = queries.op6_quality(spark, SF).toPandas()
    docs = spark.read.parquet(SF + "/documents.parquet").count()
    labels = spark.read.parquet(SF + "/labels.parquet").toPandas()
    assert len(got) == docs and got["score"].between(0, 1).all()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    assert (got["predicted"] == (got["score"] >= 0.7)).all()
    held = got[got["held_out"]].merge(labels, on="doc_id")
    assert len(held) > 50
    assert (held["predicted"] == held["quality"]).mean() > 0.95
    assert (held[held["quality"] == 1]["predicted"] == 1).mean() > 0.97
    assert got["predicted"].isin([0, 1]).all()


def test_odd_documents(spark):
    rng = random.Random(0)
    rows = [(i, "\n".join(prose(rng, 30).capitalize() + "." for _ in range(3)) if i % 2 else "### " * 40) for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(3, None, 0), (None, 1, 0), (9999, 1, 0)], "doc_id long, quality int, toxic int")
    extra = [(100, None), (101, ""), (102, "\n" * 5000), (103, prose(rng, 50_000)), (5, rows[5][1]), (None, rows[7][1])]
    docs = documents(spark, rows + extra, {"score": 9.0, "label": "clash", "good": 1, "held_out": "x"})
    out = q.score_quality(docs, labels).collect()
    assert len(out) == len(rows) + len(extra) and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r for r in out}
    assert by[100].score == by[101].score and by[None].held_out is False
    assert sum(by[i].predicted == i % 2 for i in range(80)) >= 78
    assert [r.score for r in out if r.doc_id == 5][0] == [r.score for r in out if r.doc_id == 5][1]


def test_nothing_to_learn_or_score(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [round(r.score, 3) for r in q.score_quality(documents(spark, [(1, "text"), (2, None)]), labels).collect()] == [0.5, 0.5]
    assert q.score_quality(documents(spark, []), labels).collect() == []


def test_one_class_only(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    out = q.score_quality(documents(spark, [(i, f"line {i}\nmore") for i in range(20)]), labels).collect()
    assert all(0 <= r.score <= 1 for r in out)

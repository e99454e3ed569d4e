import random
import zlib

import numpy as np
import pyarrow as pa

from helpers import documents, prose
from postlake.llm import langid as g
from postlake.llm import queries
from postlake.llm.common import text_bytes

SF = "/root/testdata/sf0.01"


def test_windows():
    rows, text, size = g.windows_of(*text_bytes(pa.array(["abc", "", "x" * 9, None], pa.string())), window=4)
    assert [bytes(r) for r in rows] == [b"abc ", b"xxxx", b"xxxx", b"x   "]
    assert text.tolist() == [0, 2, 2, 2] and size.tolist() == [3, 4, 4, 1]


def test_training_and_folded_tables():
    rng = np.random.default_rng(0)
    label = rng.integers(0, 3, 300)
    rows = np.stack([np.concatenate([rng.integers(97, 123, 20), np.frombuffer([b"xq", b"zzk", b"jvjv"][k] * 4, np.uint8)[:8], rng.integers(97, 123, 20)]) for k in label]).astype(np.uint8)
    model = g.train(rows[:200], label[:200], 3, epochs=25)
    p = g.probabilities(rows, model)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5)
    assert (p[200:].argmax(axis=1) == label[200:]).mean() > 0.9
    assert np.allclose(p, g.probabilities(rows, model, step=7), atol=1e-6)
    one = np.array([[max(sum(t[b] for t, b in zip([t[:, f] for t in tables], row[i:i + len(tables)])) for i in range(len(row) - len(tables) + 1))
                     for tables in model["tables"] for f in range(g.FILTERS)] for row in rows[:2]])
    z = np.maximum(one, 0) @ model["out"] + model["bias"]
    assert np.allclose(np.exp(z - z.max(axis=1, keepdims=True)) / np.exp(z - z.max(axis=1, keepdims=True)).sum(axis=1, keepdims=True), p[:2], atol=1e-4)


def test_gradient_moves_all_weights():
    rng = np.random.default_rng(0)
    rows = rng.integers(97, 123, (64, 16)).astype(np.uint8)
    a, b = (g.train(rows, rng.integers(0, 2, 64), 2, epochs=e) for e in (0, 1))
    for x, y in zip(a["tables"], b["tables"]):
        assert all((u != v).any() for u, v in zip(x, y))


def test_long_texts_count_whole(monkeypatch):
    rng = np.random.default_rng(0)
    model = {"langs": ["a", "b"]} | g.train(rng.integers(97, 123, (64, g.WINDOW)).astype(np.uint8), rng.integers(0, 2, 64), 2, epochs=1)
    texts = pa.array([prose(random.Random(1), 2000), "", None, "short", prose(random.Random(2), 900)], pa.string())
    want = g.classify(texts, model)
    monkeypatch.setattr(g, "RUN_BYTES", 3 * g.WINDOW)
    got = g.classify(texts, model)
    assert got[0] == want[0] and np.allclose(got[1], want[1]) and got[0][1] == got[0][2] == "und"


def brute_classify(text, model):
    """Language and score with plain loops: every window's filters at every place, softmax, mean by bytes."""
    raw = (text or "").encode()
    total = np.zeros(len(model["langs"]))
    for lo in range(0, len(raw), g.WINDOW):
        own = raw[lo:lo + g.WINDOW]
        row = own + b" " * (g.WINDOW - len(own))
        pooled = [max(sum(float(t[b][f]) for t, b in zip(tables, row[i:])) for i in range(g.WINDOW - len(tables) + 1))
                  for tables in model["tables"] for f in range(g.FILTERS)]
        z = np.maximum(pooled, 0) @ model["out"].astype(float) + model["bias"]
        p = np.exp(z - z.max())
        total += len(own) * p / p.sum()
    return total / max(1, len(raw))


def test_query_predicts_as_brute_force(spark):
    """The query's predictions, from the model fitted on the same rows, by plain loops over whole texts of a sample's rows."""
    docs = spark.read.parquet(SF + "/documents.parquet")
    model = g.fit(docs, held_out=g.F.pmod(g.crc_of("doc_id"), g.F.lit(5)) == 0)
    got = {r.doc_id: r for r in queries.op9_language(spark, SF).collect()}
    rows = sorted(docs.collect(), key=lambda r: (len(r.text or ""), r.doc_id))
    for r in rows[:30] + [x for x in rows if 300 < len(x.text or "") < 700][:25]:
        mean = brute_classify(r.text, model)
        if not any(c.isalpha() for c in r.text or ""):
            assert (got[r.doc_id].lang_pred, got[r.doc_id].score) == ("und", 0.0)
            continue
        assert abs(got[r.doc_id].score - mean.max()) < 1e-3
        if np.sort(mean)[-1] - np.sort(mean)[-2] > 1e-3:
            assert got[r.doc_id].lang_pred == model["langs"][mean.argmax()]


def test_columns_named_like_results(spark):
    docs = documents(spark, [(i, "aha oho " * 9 if i % 2 else "ßüß öde " * 9, "xy"[i % 2]) for i in range(40)], {"score": "s", "lang_pred": 1, "held_out": 2, "found": 3})
    out = g.predict_language(docs)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score"] and {r.lang_pred for r in out.collect()} == {"x", "y"}


def test_held_out_accuracy(spark):
    got = queries.op9_language(spark, SF).toPandas()
    docs = spark.read.parquet(SF + "/documents.parquet").select("doc_id", "lang").toPandas()
    both = got.merge(docs, on="doc_id")
    assert len(got) == len(docs) and got["score"].between(0, 1).all()
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 5 == 0)).all()
    assert set(got["lang_pred"]) <= set(docs["lang"]) | {"und"}
    held = both[both["held_out"]]
    assert len(held) > 100 and (held["lang"] == held["lang_pred"]).mean() > 0.97


def test_odd_documents(spark):
    rows = [(i, ["aha oho " * 20, "ßüß öde " * 20][i % 2], ["x", "y"][i % 2]) for i in range(60)]
    extra = [(100, None, "x"), (101, "", "x"), (102, "12 34 !?", "x"), (103, "漢字", None), (104, "aha oho " * 40_000, None), (None, "ßüß öde " * 9, "y"), (3, rows[3][1], "y")]
    docs = documents(spark, rows + extra, {"score": "clash", "rows": 1, "_found": 2, "turn": 3})
    out = {(r.doc_id, r.lang_pred) for r in g.predict_language(docs).collect()}
    assert {(100, "und"), (101, "und"), (102, "und"), (104, "x"), (None, "y"), (3, "y")} <= out
    assert {(i, "xy"[i % 2]) for i in range(60)} <= out


def test_nothing_to_learn(spark):
    out = g.predict_language(documents(spark, [(1, "text", None), (2, None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in out] == [("und", 0.0)] * 2
    assert g.predict_language(documents(spark, [])).collect() == []


def test_sample_is_bounded_by_rows_and_skips_texts_without_letters(spark, monkeypatch):
    import postlake.llm.langid as module

    rows = [(i, f"word {i} {k % 2}", "en") for i in range(5) for k in range(10)]
    rows += [(100 + i, None if i % 2 else "12 34", "fr") for i in range(40)] + [(i, f"mot {i}", "fr") for i in (200, 201, 202)]
    monkeypatch.setattr(module, "train", lambda x, label, n: {"count": [int((label == k).sum()) for k in range(n)]})
    model = module.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3), sample=3)
    assert model["langs"] == ["en", "fr"] and model["count"] == [3, 3]

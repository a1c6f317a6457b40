"""Language and quality models: held-out accuracy, labels kept out of scores, parts by hand, edge cases."""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from casebridge.llm import langid, quality, queries
from casebridge.llm.tables import crc_mod, load

LARGER = "/root/testdata/sf0.1"


def test_crc_mod(spark):
    rows = spark.range(50).select("id", crc_mod("id", 5).alias("m")).collect()
    assert all(r["m"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in rows)


def test_language_accuracy(spark):
    found = {r["doc_id"]: r for r in queries.QUERIES["op7_language_id"](spark, LARGER).collect()}
    docs = load(spark, LARGER, "documents").select("doc_id", "lang").collect()
    held = [d for d in docs if found[d["doc_id"]]["held_out"]]
    assert all(found[d["doc_id"]]["held_out"] == (zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1) for d in docs)
    assert np.mean([found[d["doc_id"]]["lang_pred"] == d["lang"] for d in held]) > 0.99
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_vectors_by_definition():
    letters, _ = langid.letter_vectors()
    text = "Ab, a"
    symbols = [0, 1, 2, 0, 1, 0]
    expected = np.zeros(langid.DIMENSIONS)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
        expected += np.roll(letters[a], 2) * np.roll(letters[b], 1).astype(int) * letters[c]
    got = list(langid.text_vectors(pa.array([text, None, "", "12 !", "x" * 3_000_000])))
    assert np.array_equal(got[0], expected)
    assert got[1] is got[2] is got[3] is None
    assert np.linalg.norm(got[4]) > 0


def test_language_edge_rows(edge_docs, no_docs, make_docs):
    model = langid.learn(edge_docs, F.lit(True))
    found = sorted((r["doc_id"], r["lang_pred"]) for r in langid.identify(edge_docs, model).collect())
    assert found == [(2, "en"), (3, "und"), (4, "en"), (4, "en"), (5, "en"), (7, "und"), (8, "en"), (9, "und")]
    assert langid.learn(no_docs, F.lit(True)) == {}
    assert langid.identify(no_docs, model).collect() == []
    assert {(r["lang_pred"], r["score"]) for r in langid.identify(edge_docs, {}).collect()} == {("und", 0.0)}
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert langid.learn(unlabelled, F.lit(True)) == {}


def test_languages_tie_by_name(make_docs):
    docs = make_docs([(1, "same words here")]).drop("lang")
    both = docs.withColumn("lang", F.explode(F.array(F.lit("zz"), F.lit("aa"))))
    assert langid.identify(docs, langid.learn(both, F.lit(True))).first()["lang_pred"] == "aa"


def test_quality_accuracy_and_cutoff(spark):
    found = {r["doc_id"]: r for r in queries.QUERIES["op6_quality_classifier"](spark, LARGER).collect()}
    labels = [(r["quality"], found[r["doc_id"]]) for r in load(spark, LARGER, "labels").collect()]
    held = [(q, r) for q, r in labels if r["held_out"]]
    assert np.mean([r["predicted"] == q for q, r in held]) > 0.97
    assert np.mean([r["predicted"] for q, r in held if q == 1]) > 0.99
    assert all(r["predicted"] == (r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in found.values())
    # calibrated: where the mean score says p, about p of the labels are 1
    scores, truth = np.array([r["score"] for _, r in held]), np.array([q for q, _ in held])
    assert abs(scores.mean() - truth.mean()) < 0.03


def test_scores_do_not_see_held_out_labels(spark, medium):
    docs, labels = load(spark, medium, "documents"), load(spark, medium, "labels")
    held = crc_mod("doc_id", 5) == 0
    flipped = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")).cast("int"))
    a, b = (quality.score(docs, quality.learn(docs, x, ~held)).orderBy("doc_id").collect() for x in (labels, flipped))
    assert a == b


def test_quality_edge_rows(spark, edge_docs, no_docs):
    schema = "doc_id long, quality int"
    none = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(2, 1), (4, 1), (7, None), (99, 0)], schema)
    both = spark.createDataFrame([(2, 1), (4, 0), (4, 1), (9, 0)], schema)
    for labels, expected in ((none, {0.5}), (one, None), (both, None)):
        rows = quality.score(edge_docs, quality.learn(edge_docs, labels, F.lit(True))).collect()
        assert len(rows) == 8 and all(0 <= r["score"] <= 1 for r in rows)
        assert expected is None or {r["score"] for r in rows} == expected
    assert quality.score(no_docs, quality.learn(no_docs, none, F.lit(True))).collect() == []


def test_context_vectors_by_definition():
    text = "a b a"
    ids = [int(quality._buckets(w.hash)[i]) for w, _, _, _ in quality._documents(pa.array([text])) for i in range(3)]
    assert ids[0] == ids[2] != ids[1]
    total = quality.context_sums(pa.array([text, "", "b"]))
    rotated = np.roll(quality.INDEX, 1, axis=1)
    assert np.array_equal(total[ids[0]], quality.INDEX[ids[1]] + rotated[ids[1]])
    assert np.array_equal(total[ids[1]], quality.INDEX[ids[0]] + rotated[ids[0]])
    assert np.count_nonzero(total.any(axis=1)) == 2


def test_context_vectors_cover_every_document(spark, make_docs, monkeypatch):
    rows = [(i, f"w{i} next x{i} {'abc'[i % 3] * 5} end") for i in range(300)] + [(300, None), (301, ""), (5, "again w5")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    monkeypatch.setattr(quality, "SAMPLE", 20)
    model = quality.learn(make_docs(rows).repartition(13), labels, F.lit(True))
    total = quality.context_sums(pa.array([t for _, t in rows]))
    assert np.array_equal(model.vectors, quality.word_vectors(total))
    assert np.count_nonzero(total.any(axis=1)) > 250  # words of unlabelled rows too


def test_temperature_softens_a_sure_network():
    r = np.random.default_rng(0)
    x = r.normal(size=(2000, 5)).astype(np.float32)
    y = (r.random(2000) < 1 / (1 + np.exp(-x[:, 0]))).astype(float)
    net = quality.train(x, y)
    p = net.probabilities(x)
    assert abs(p.mean() - y.mean()) < 0.05
    assert np.corrcoef(p, x[:, 0])[0, 1] > 0.8

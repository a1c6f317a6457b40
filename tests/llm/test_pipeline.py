"""The pipeline stage by stage against plain versions on its own inputs, and its whole run."""

import random
import re
import sys

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from casebridge.llm import decontam, langid, pii, tables
from casebridge.llm.tables import load, split_by_ids, without_ids

sys.path.insert(0, __file__.rsplit("/", 1)[0])
from test_minhash import brute_force  # noqa: E402
from test_packing import check_packed  # noqa: E402


def texts_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark, medium, tmp_path_factory):
    """The output of every stage, written and read like in a run."""
    root, docs, found = tmp_path_factory.mktemp("stages"), load(spark, medium, "documents"), [load(spark, medium, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, medium).write.parquet(f"file:{root}/{name}")
        docs = spark.read.parquet(f"file:{root}/{name}")
        found.append(docs)
    return found


def test_language_keeps_what_has_letters(stages):
    before, after = texts_of(stages[0]), texts_of(stages[1])
    assert set(after) >= {i for i, t in before.items() if t and len(re.findall(r"[^\W\d_]", t)) > 20}
    assert all(after[i] == before[i] for i in after)


def test_near_duplicates_keep_one_of_each_group(stages):
    before, after = texts_of(stages[1]), texts_of(stages[2])
    assert set(after) == {i for i, _, _, kept in brute_force(list(before.items())) if kept}


def test_documents_with_test_items_go(stages, spark, medium):
    before, after = texts_of(stages[2]), texts_of(stages[3])
    items = [decontam.normalise(r["text"]) for r in load(spark, medium, "benchmark").collect()]
    leaks = {i for i, t in before.items() if any(x in decontam.normalise(t) for x in items)}
    assert leaks and not leaks & set(after)
    assert set(before) - set(after) - leaks == set()


def test_personal_data_is_masked(stages):
    before, after = texts_of(stages[3]), texts_of(stages[4])
    assert before.keys() == after.keys()
    assert any(before[i] != after[i] for i in before)
    assert all(after[i] == pii.masked(before[i]) for i in before)
    assert all(r["n_chars"] == len(r["text"]) for r in stages[4].collect())


def test_columns_and_packing(stages):
    assert all(s.schema == stages[0].schema for s in stages[:-1])
    sizes = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in texts_of(stages[4]).items()}
    check_packed(stages[5].collect(), sizes, corpus_pipeline.packing.CAPACITIES)


def test_whole_run(spark, medium, stages):
    assert sorted(map(str, corpus_pipeline.run(spark, medium).collect())) == sorted(map(str, stages[-1].collect()))


def test_edge_rows(spark, small, edge_docs, no_docs):
    docs = edge_docs
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        assert docs.columns == edge_docs.columns
        kept.append(sorted(r["doc_id"] for r in docs.collect()))
    assert kept == [[2, 4, 4, 5, 8], [2, 5, 8], [2, 5, 8], [2, 5, 8]]
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, no_docs, small).collect() == []


def test_rows_that_repeat_an_id_and_text_leave_one(spark, small, make_docs):
    docs = make_docs([(1, "a b c d e f g")] * 3 + [(2, "h i j k l m n"), (3, None)])
    assert sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs, small).collect()) == [1, 2, 3]


def test_rows_of_one_id_are_judged_by_their_texts(spark, small, make_docs):
    """Three shapes: different texts under one id, a copy under an id that has another text, and both repeated."""
    copied = "one two three four five six seven"
    rows = [(0, copied), (1, "a b c d e f g"), (1, "h i j k l m n"), (5, "o p q r s t u"), (5, copied), (6, copied), (6, copied)]
    kept = corpus_pipeline.near_duplicates(spark, make_docs(rows), small).collect()
    assert sorted((r["doc_id"], r["text"]) for r in kept) == [(0, copied), (1, "a b c d e f g"), (1, "h i j k l m n"), (5, "o p q r s t u")]
    item = load(spark, small, "benchmark").first()["text"]
    rows = [(1, "a text of its own"), (1, f"before {item} after"), (2, "3.14 = 2"), (2, "--- 12 ---"), (2, None)]
    assert [r["text"] for r in corpus_pipeline.decontamination(spark, make_docs(rows), small).where("doc_id = 1").collect()] == ["a text of its own"]
    assert [r["text"] for r in corpus_pipeline.language(spark, make_docs([*rows, (2, "the words of a text")]), small).where("doc_id = 2").collect()] == ["the words of a text"]


CODE = """def total(rows):
    out = {}
    for i, (key, value) in enumerate(rows):
        out.setdefault(key, []).append(value * 2 + i)
    return {k: sum(v) / len(v) for k, v in out.items() if v}
"""
UNLIKE_PROSE = [
    CODE,
    CODE * 5,
    "C8H10N4O2 + 3 HNO3 -> C8H7N7O8 + 3 H2O (pKa 10.4, mp 238 C); NaOH, KMnO4, H2SO4, CH3COOH",
    "NATO UNESCO UNICEF OECD WTO IMF NASA ESA CERN DARPA IEEE ACM ISO IETF W3C",
    "qty;sku;price\n12;XK-99;4.50\n7;ZZ-01;19.99\n" * 20,
    "Nguyen Thi Bich Ngoc, Szymon Wojciechowski, Gruffydd ap Llwyd, Xochitl Quetzalli, Bjork Gudmundsdottir",
]


def test_labelled_rows_unlike_prose_stay(spark, medium, stages):
    columns = ["doc_id", "text", "lang"]
    odd = spark.createDataFrame([(-1 - i, t, "en") for i, t in enumerate(UNLIKE_PROSE)], "doc_id long, text string, lang string")
    kept = texts_of(corpus_pipeline.language(spark, stages[0].select(columns).unionByName(odd), medium))
    assert set(range(-len(UNLIKE_PROSE), 0)) <= set(kept)
    assert set(kept) - set(range(-len(UNLIKE_PROSE), 0)) == set(texts_of(stages[1]))


def test_column_names_that_the_stages_use(spark, small, make_docs):
    docs = make_docs([(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (3, "mail a@b.c now")])
    for name in ("once", "_word", "_bits", "id_word", "id_bits", "affected", "row_key", "row", "text_key", "kept", "lang_pred", "letters", "class"):
        docs = docs.withColumn(name, F.lit(f"own {name}"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small)
        own = docs.first()
        assert all(own[c] == f"own {c}" for c in docs.columns if c in ("once", "_word", "_bits", "id_word", "id_bits", "row_key", "class"))
    assert sorted(r["doc_id"] for r in docs.collect()) == [1, 3]
    assert corpus_pipeline.packed(spark, docs, small).count() == 2


@pytest.mark.parametrize("words", [1, 1 << 20])
def test_id_filter_loses_nothing_when_full(spark, monkeypatch, words):
    monkeypatch.setattr(tables, "FILTER_ROWS", words)
    rows = spark.range(-500, 500).select("id", F.lit("x").alias("_kept")).unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS id, 'x' AS _kept"))
    ids = spark.range(0, 300).select((F.col("id") * 2).alias("id"))
    maybe, rest = split_by_ids(rows, ids, "id")
    assert maybe.count() + rest.count() == 1001
    assert maybe.join(ids, "id").count() == 250
    assert rest.join(ids, "id").count() == 0
    assert without_ids(rows, ids, "id").count() == 751
    assert without_ids(rows, ids.limit(0), "id").count() == 1001


def test_language_rejects_random_and_foreign_texts_of_any_length(spark, medium, stages):
    r = random.Random(4)
    alphabets = ["abcdefghijklmnopqrstuvwxyz", [chr(c) for c in range(0x430, 0x450)], [chr(c) for c in range(0x4E00, 0x5E00)]]
    made = [" ".join("".join(r.choices(a, k=r.randrange(3, 9))) for _ in range(n)) for a in alphabets for n in (20, 50, 200, 500, 3000) for _ in range(6)]
    planted = spark.createDataFrame([(-1 - i, t, None) for i, t in enumerate(made)], "doc_id long, text string, lang string")
    docs = stages[0].select("doc_id", "text", "lang").unionByName(planted)
    assert set(texts_of(corpus_pipeline.language(spark, docs, medium))) == set(texts_of(stages[1]))


def test_rare_languages_are_learned(spark, make_docs):
    docs = make_docs([(i, t) for i, t in enumerate(["the same words", "andere woorden hier"] * 2)])
    many = spark.range(300).select(F.lit(9).cast("long").alias("doc_id"), F.lit("the same words").alias("text"), F.format_string("a%03d", "id").alias("lang"))
    rare = docs.where("doc_id = 1").select("doc_id", "text", F.lit("z").alias("lang"))
    prototypes = langid.learn(many.unionByName(rare), F.lit(True))
    assert len(prototypes) == 301
    assert langid.identify(rare, prototypes).first()["lang_pred"] == "z"

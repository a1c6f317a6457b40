"""One query per operator over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebridge.llm import collocations, decontam, hard_negatives, html_text, langid, licenses, minhash, packing, pii, quality, secret_scan, simhash, topk
from casebridge.llm.tables import count_kind, crc_mod, load, span_list

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(load(spark, sf_dir, "documents"))


def _with_spans(found: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[count_kind(base, k).alias(f"n_{k}") for k in kinds],
        F.sha2(span_list(base), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added"),
    )


def op2_pii(spark, sf_dir):
    return _with_spans(pii.find_pii(load(spark, sf_dir, "documents")), pii.KINDS)


def op3_html_extraction(spark, sf_dir):
    found = html_text.extract_text(load(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(load(spark, sf_dir, "documents")).drop("text_key")


def op5_secret_scan(spark, sf_dir):
    return _with_spans(secret_scan.find_secrets(load(spark, sf_dir, "documents")), secret_scan.KINDS[:3])


def op6_quality_classifier(spark, sf_dir):
    docs, held_out = load(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 0
    model = quality.learn(docs, load(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(docs, model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= quality.CUTOFF).cast("int").alias("predicted"))


def op7_language_id(spark, sf_dir):
    docs, held_out = load(spark, sf_dir, "documents"), crc_mod("doc_id", 3) == 1
    found = langid.identify(docs, langid.learn(docs, ~held_out))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_exact_top_k(spark, sf_dir):
    return topk.top_k(load(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(100)) == 0)


def op9_benchmark_decontamination(spark, sf_dir):
    return decontam.find_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op10_license_scan(spark, sf_dir):
    found = licenses.scan_licenses(load(spark, sf_dir, "documents"))
    labels = F.array_sort(F.array_union("base", F.transform("notices", lambda n: n["name"])))
    best = F.greatest(F.when(F.size("base") > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(F.transform("notices", lambda n: n["containment"])), F.lit(0.0)))
    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min("places").cast("long").alias("first_word"),
        F.array_max("places").cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort("base")).alias("base_labels"),
        F.concat_ws(",", labels).alias("labels"),
        best.alias("score"),
    )


def op11_collocations(spark, sf_dir):
    return collocations.collocations(load(spark, sf_dir, "documents"))


def op12_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(load(spark, sf_dir, "embeddings").withColumn("label", label), F.pmod("vec_id", F.lit(50)) == 0)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_pii,
        op3_html_extraction,
        op4_minhash_near_dedup,
        op5_secret_scan,
        op6_quality_classifier,
        op7_language_id,
        op8_exact_top_k,
        op9_benchmark_decontamination,
        op10_license_scan,
        op11_collocations,
        op12_simhash_near_dedup,
        op13_hard_negatives,
    )
}

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


def _license_sql() -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = f"translate({{}}, '{letters}', '{letters.lower()}')"
    known = licenses.templates(licenses.NOTICES, {})
    notices = ", ".join(f"('{name}', {words!r}, {need}, {licenses.run_length(licenses.NOTICES[name])})" for _, name, words, need in known)
    at = " UNION ALL ".join(
        f"SELECT doc_id, '{label}' AS label, unnest(list_filter(range(len(ws)), lambda i: "
        + " AND ".join(f"ws[i + {k + 1}] = '{w}'" for k, w in enumerate(phrase.split()))
        + ")) AS place FROM w"
        for phrase, label in licenses.PHRASES.items()
    )
    return f"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all({lowered.format("coalesce(text, '')")}, '{word}') AS ws FROM documents),
standing AS ({at}),
base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
  list_sort(list(DISTINCT label)) AS labels FROM standing GROUP BY doc_id),
notices(name, words, need, run) AS (VALUES {notices}),
near AS (SELECT * FROM w, notices WHERE len(list_intersect(words, ws)) >= need),
counted AS (SELECT *, list_max(list_transform(range(len(ws)), lambda i: len(list_intersect(words, ws[i + 1:i + run])))) AS most FROM near),
held AS (SELECT DISTINCT doc_id, name, most / len(words) AS containment FROM counted WHERE most >= need),
best AS (SELECT doc_id, list(DISTINCT name) AS names, max(containment) AS containment FROM held GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
  coalesce(array_to_string(base.labels, ','), '') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(names, [])))), ',') AS labels,
  greatest(CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END, coalesce(containment, 0.0::DOUBLE)) AS score
FROM w LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id)
"""


_COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces),
grams AS (
  SELECT lang, k AS words, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: array_to_string(ws[i:i + k - 1], ' '))) AS phrase
  FROM w, (VALUES (1), (2), (3), (4)) sizes(k) WHERE len(ws) >= k),
f AS (SELECT lang, phrase, words, count(*) AS a FROM grams GROUP BY ALL),
totals AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT *, string_split(phrase, ' ') AS ws FROM f WHERE words > 1 AND a >= 30),
cuts AS (SELECT *, unnest(range(1, words)) AS cut FROM c),
s AS (
  SELECT cuts.lang, cuts.phrase, cut, cuts.a, x.a AS l, y.a AS r, (2000000::HUGEINT * cuts.a // (x.a + y.a))::BIGINT AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(ws[1:cut], ' ')
  JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(ws[cut + 1:], ' ')),
best AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sized AS (SELECT lang, a, ws, words, unnest(range(2, words)) AS size FROM c),
placed AS (SELECT *, unnest(range(1, words - size + 2)) AS place FROM sized),
held AS (SELECT lang, array_to_string(ws[place:place + size - 1], ' ') AS phrase, max(a) AS most FROM placed GROUP BY ALL),
kept AS (
  SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best LEFT JOIN held USING (lang, phrase) WHERE most IS NULL OR 100 * most::HUGEINT < 80 * a::HUGEINT)
SELECT lang, rank, phrase, a, l, r, n, score FROM kept JOIN totals USING (lang) WHERE rank <= 2000
"""


_HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
p AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM p WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
negatives AS (
  SELECT o.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
    row_number() OVER (PARTITION BY o.anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
  FROM positives o JOIN p ON p.anchor_id = o.anchor_id AND NOT same
    AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= 3
"""


ORACLE: dict[str, str] = {
    "op8_exact_top_k": _TOP_K,
    "op10_license_scan": _license_sql(),
    "op11_collocations": _COLLOCATIONS,
    "op13_hard_negatives": _HARD_NEGATIVES,
}

"""A corpus pipeline over ``documents``: language, near duplicates, benchmark passages, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as Parquet and read again as the
next stage's ``docs``. All but the last return the columns of ``docs``; every decision is taken on the stage's input.

Decisions are about rows, told apart by id and text: of rows that share an id, each stays or goes by its own text. Columns of
any name pass through. An empty table gives an empty one, and texts of any length are read whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebridge.llm import decontam, langid, minhash, packing, pii
from casebridge.llm.tables import load, shared_root, split_by_ids, staged, unused, without_ids

#: Unlabelled texts are judged by labelled ones of as many letters, in classes from so many letters on, doubling.
LETTERS, CLASSES = 20, 12
#: Labelled texts a language needs in a class, and in those above, before others are judged by them.
WITNESSES = 30


def _by_row(docs: DataFrame, *more: str) -> tuple[DataFrame, str]:
    """``docs`` with a column of its own that tells rows apart by id and text (and ``more``), and the column's name."""
    name = unused(docs, "row_key")
    return docs.withColumn(name, F.struct("doc_id", F.xxhash64("text").alias("text_key"), *more)), name


def least_likeness(found: DataFrame) -> dict[tuple[str, int], float]:
    """For each language and class of length the least likeness of a labelled text of that language, of this class or above.

    With fewer than ``WITNESSES`` such texts the classes below come in until there are enough: longer texts are no less
    alike. A language with fewer texts in all has no bound. A row per language and class reaches the driver.
    """
    own = found.where((F.col("lang") == F.col("lang_pred")) & F.col("class").isNotNull())
    counted = own.groupBy("lang", "class").agg(F.count("*").alias("n"), F.min("score").alias("least")).collect()
    bounds = {}
    for lang in {r["lang"] for r in counted}:
        n, least = 0, 1.0
        of = {r["class"]: r for r in counted if r["lang"] == lang}
        for c in range(CLASSES - 1, -1, -1):
            if c in of:
                n, least = n + of[c]["n"], min(least, of[c]["least"])
            if n >= WITNESSES:
                bounds |= {(lang, d): least for d in range(c, CLASSES) if (lang, d) not in bounds}
    return bounds


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep texts that have letters and may be of a language of the table; learned from the rows' own labels.

    A row with a label is kept: its text (code, a table, a list of names) may be unlike the prose of its language. A row
    without one goes if it is less like its nearest language than every labelled text of that language and of its length or
    more (``least_likeness``). Null texts go, and texts without letters; texts of fewer than ``LETTERS`` letters say too
    little to be rejected for.
    """
    prototypes = langid.learn(docs, F.lit(True))
    keyed, row = _by_row(docs, "lang")
    judged = langid.identify(keyed, prototypes, row).select(F.col(row).alias("row"), F.col(f"{row}.lang").alias("lang"), "lang_pred", "score", "letters")
    # Classes double: 20 letters, 40, 80 ..
    step = sum((F.col("letters") >= LETTERS << c).cast("int") for c in range(1, CLASSES))
    found = staged(judged.withColumn("class", F.when(F.col("letters") >= LETTERS, step)), "languages")
    bound = F.lit(None).cast("double")
    for (lang, c), least in least_likeness(found).items():
        bound = F.when((F.col("lang_pred") == lang) & (F.col("class") == c), least).otherwise(bound)
    unlike = F.col("lang").isNull() & F.coalesce(F.col("score") < bound, F.lit(False))
    rejected = found.where((F.col("lang_pred") == langid.UNDETERMINED) | unlike).select(F.col("row").alias(row)).distinct()
    kept = without_ids(keyed.where(F.col("text").isNotNull()), staged(rejected, "rejected"), row)
    return kept.select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group; of rows that repeat an id and text, one.

    Rows of one id with different texts are judged apart. Rows without an id stay; null and blank texts are like nothing.
    """
    found = staged(minhash.near_duplicates(docs), "duplicates")
    keyed, row = _by_row(docs)
    once = unused(keyed, "once")
    judged = found.groupBy(F.struct("doc_id", "text_key").alias(row)).agg(F.count_if("kept").alias("kept"))
    affected = staged(judged.where(f"kept <> 1 AND {row}.doc_id IS NOT NULL").select(row, (F.col("kept") > 1).alias(once)), "affected")
    maybe, untouched = split_by_ids(keyed, affected, row)
    joined = maybe.join(affected, row, "left")
    first = joined.where(once).dropDuplicates([row])
    rest = joined.where(F.col(once).isNull())
    return untouched.select(docs.columns).unionByName(rest.select(docs.columns)).unionByName(first.select(docs.columns))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a test item. Null and empty texts hold none."""
    keyed, row = _by_row(docs)
    found = decontam.find_items(keyed, load(spark, sf_dir, "benchmark"), row).select(row).distinct()
    return without_ids(keyed, staged(found, "leaks"), row).select(docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by marks; ``n_chars`` follows the text. Null texts stay null."""
    masked = pii.mask_pii(docs)
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes. Texts without words take no place."""
    return packing.pack_documents(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packed),
]

#: Cosines, signatures, edit distances and packing have no SQL form; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read back."""
    docs = load(spark, sf_dir, "documents")
    root = f"{shared_root(spark)}/casebridge-llm/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs

"""Language by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A run of three letters is bound into one vector: the letters' vectors,
permuted twice, once and not at all, multiplied. A text's vector is the bundle (sum) of its runs, a language's
prototype the bundle of its texts' unit vectors. A text goes to the language with the largest cosine.

Letters are folded to lower case; a stretch of other characters counts as one blank, and a text begins and ends with
one. Letters beyond a-z share ``SYMBOLS`` - 27 vectors by code point.

Prototypes are learned from a sample of about ``SAMPLE`` texts a language, picked by a hash of the id; sums are of
integers, so a model does not depend on the order of tasks. Every language that labels a text with letters is learned.

Null, empty and letter-free texts are ``und`` with score 0, as is every text when nothing could be learned. Ties go
to the name that sorts first. Texts count whole. Columns other than those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebridge.llm.words import slices

DIMENSIONS = 2048
SYMBOLS = 64
SAMPLE = 1_500
UNDETERMINED = "und"
SLICE_CHARS = 1 << 18
#: Runs of letters that are bound at once.
RUNS = 1 << 10
#: Prototypes are sums of unit vectors in steps of 1 / SCALE.
SCALE = 1 << 16


@cache
def symbol_table() -> np.ndarray:
    """Symbol of every code point: 0 for what is no letter, 1 to 26 for a to z."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        c = chr(point)
        if c.isalpha():
            low = ord(c.lower()[0])
            table[point] = low - 96 if 97 <= low <= 122 else 27 + low % (SYMBOLS - 27)
    return table


@cache
def letter_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Vectors of single letters, and of ordered pairs bound as the first two of a run."""
    letters = np.random.default_rng(7).choice(np.array([-1, 1], np.int8), (SYMBOLS, DIMENSIONS))
    pairs = np.roll(letters, 2, axis=1)[:, None, :] * np.roll(letters, 1, axis=1)[None, :, :]
    return letters, pairs.reshape(SYMBOLS * SYMBOLS, DIMENSIONS)


def text_vectors(column: pa.Array) -> Iterator[np.ndarray | None]:
    """The vector of each text; None for a text without letters."""
    return (v for v, _ in vectors_and_letters(column))


def vectors_and_letters(column: pa.Array) -> Iterator[tuple[np.ndarray | None, int]]:
    """The vector of each text, None for a text without letters, and how many letters it has."""
    column = column.cast(pa.large_string()).fill_null("")
    sizes = pc.utf8_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(sizes)])
    letters, pairs = letter_vectors()
    table = symbol_table()
    for a, b in slices(ends, SLICE_CHARS):
        text = "".join(column.slice(a, b - a).to_pylist())
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = table[points]
        for i in range(a, b):
            own = symbols[ends[i] - ends[a] : ends[i + 1] - ends[a]]
            n_letters = int(np.count_nonzero(own))
            if not n_letters:
                yield None, 0
                continue
            own = np.concatenate([[0], own, [0]]).astype(np.int32)
            keep = own != 0
            keep[1:] |= own[:-1] != 0
            keep[0] = True
            own = own[keep]
            runs, counts = np.unique((own[:-2] * SYMBOLS + own[1:-1]) * SYMBOLS + own[2:], return_counts=True)
            total = np.zeros(DIMENSIONS, np.float32)
            for first in range(0, len(runs), RUNS):
                some = runs[first : first + RUNS]
                bound = pairs[some // SYMBOLS]
                bound *= letters[some % SYMBOLS]
                total += counts[first : first + RUNS].astype(np.float32) @ bound.astype(np.float32)
            yield total, n_letters


def learn(docs: DataFrame, learnable: Column, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Unit prototype of each language, from rows where ``learnable`` holds and the language is not null."""
    known = docs.where(learnable & F.col(lang_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    chances = known.groupBy("lang").agg(F.least(F.lit(1.0), F.lit(float(SAMPLE)) / F.count(F.lit(1))).alias("chance"))
    picked = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.col("chance") * (1 << 20)
    sample = known.join(F.broadcast(chances), "lang").where(picked).select("lang", "text")  # a row for each language

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, v in zip(batch.column(0).to_pylist(), text_vectors(batch.column(1)), strict=True):
                if v is not None and (size := np.linalg.norm(v)):
                    total.setdefault(lang, np.zeros(DIMENSIONS, np.int64))[:] += np.rint(v * (SCALE / size)).astype(np.int64)
        langs = sorted(total)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(langs, object), DIMENSIONS), pa.string()),
                pa.array(np.tile(np.arange(DIMENSIONS, dtype=np.int32), len(langs))),
                pa.array(np.concatenate([np.zeros(0, np.int64), *(total[k] for k in langs)])),
            ],
            names=["lang", "place", "value"],
        )

    parts = sample.mapInArrow(sums, "lang string, place int, value long")
    found: dict[str, np.ndarray] = {}
    for r in parts.groupBy("lang", "place").agg(F.sum("value").alias("value")).toLocalIterator():
        found.setdefault(r["lang"], np.zeros(DIMENSIONS))[r["place"]] = r["value"]
    return {k: (v / np.linalg.norm(v)).astype(np.float32) for k, v in sorted(found.items()) if v.any()}


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred``, ``score`` (the cosine, not below 0) and ``letters`` (how many) of every row."""
    names = [UNDETERMINED, *prototypes]
    matrix = np.stack(list(prototypes.values())) if prototypes else np.zeros((0, DIMENSIONS), np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, score, letters = [], [], []
            for v, n in vectors_and_letters(batch.column(1)):
                size = 0.0 if v is None else float(np.linalg.norm(v))
                near = matrix @ v / size if size else matrix[:0, 0]
                best = int(near.argmax()) if len(near) else -1
                lang.append(names[best + 1])
                score.append(min(1.0, max(0.0, float(near[best]))) if best >= 0 else 0.0)
                letters.append(n)
            columns = [batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(letters, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "lang_pred", "score", "letters"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, F.col(text_col).alias("text")).mapInArrow(run, f"{id_col} {kind}, lang_pred string, score double, letters long")

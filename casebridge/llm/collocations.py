"""Frequent phrases per language, found with Misra-Gries summaries and then counted exactly.

Texts are lower-cased (A-Z), split at ``. , ; : ! ?`` and line ends into pieces, and those at spaces and tabs into words. A
phrase is 1 to ``LONGEST`` words in a row within a piece.

1. *Summaries.* Every task hashes the phrases of its texts and adds them up in one summary per hash partition; what a
   summary holds is sorted, packed and shuffled. A partition's summaries are merged one by one. Whenever the merged one
   holds more than its capacity, the count of the next largest key is taken off all keys (Misra-Gries, in its mergeable
   form). The capacity exceeds the partition's mass (its occurrences so far) divided by the least count, and nothing is
   taken off that would bring the sum of what was taken to the least count, so every frequent phrase survives; rare ones may.
2. *Counts.* Survivors set bits in a table of bounded size. A second pass over the texts counts phrases that meet it, by their
   words, first in the task and then per phrase. Counts below the least are dropped, so survivors that were not
   frequent, and chance hits of the bits, do no harm. The fuller the table of bits, the more phrases are counted for nothing.
3. *Scores.* Each phrase is cut after every word and joined with the counts of both parts, which are at least as frequent
   as it is. Phrases that a longer one nearly always holds are dropped; the longest counts per part are an aggregate.

Keys of step 1 are 32 bits in a partition: a collision only adds survivors. Step 2 tells phrases apart by 64 bits within a
task's slice, and by their words from there on.

Null, empty and blank texts have no words; null languages are ``und``. Repeated rows count each. Ties in score and count go
by the phrase's bytes. Very long texts are read whole; a task holds one text's phrases at least. Empty tables give no
rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casebridge.llm.tables import staged
from casebridge.llm.words import LOWER_ASCII, MULTIPLIER, Words, byte_set, mixed, slices, utf8

UNKNOWN = "und"
LONGEST = 4
LEAST = 30
#: A longer phrase that has this share (percent) of a phrase's occurrences takes its place.
SWALLOWED = 80
#: Scores are 2 * a / (l + r) in units of a millionth.
SCALE = 2_000_000
KEPT = 2_000

#: Phrases (by an estimate) that a hash partition has, and the least number of counters it may hold.
PARTITION_MASS = 16_000_000
CAPACITY = 1 << 20
#: Phrases a task adds up before it writes or merges summaries, and bytes of text it cuts at a time.
TASK_PHRASES = 1 << 20
SLICE_BYTES = 1 << 20
#: Table of bits: bits for each survivor, within these bounds, and places each sets.
BITS_EACH, BITS_LEAST, BITS_MOST, PROBES = 32, 1 << 16, 1 << 28, 3

_BREAKS = byte_set((10, 13)) | byte_set(*((ord(c), ord(c)) for c in ".,;:!?"))
_WORD = ~(_BREAKS | byte_set((9, 9), (32, 32)))
_KEY = np.uint64(0xFFFFFFFF)


class Phrases:
    """Phrases of some texts: ``hashes[k]`` and ``at[k]`` (index of the first word) of those of k + 1 words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, languages: np.ndarray) -> None:
        words = Words(data, offsets, _WORD, LOWER_ASCII)
        self.words, self.counts = words, np.diff(words.of_text)
        text = np.repeat(np.arange(len(self.counts)), self.counts)
        breaks = np.concatenate([[0], np.cumsum(_BREAKS[data])])
        piece = breaks[words.start] if len(words.start) else np.zeros(0, np.int64)
        together = np.zeros(len(text), bool)  # with the next word
        together[:-1] = (text[1:] == text[:-1]) & (piece[1:] == piece[:-1])
        self.at = [np.arange(len(text))]
        chain = mixed(words.hash ^ languages[text])
        self.hashes = [chain]
        for k in range(1, LONGEST):
            more = together[self.at[-1] + k - 1]
            self.at.append(self.at[-1][more])
            chain = mixed(chain[more] * np.uint64(MULTIPLIER) + words.hash[self.at[-1] + k] + np.uint64(k))
            self.hashes.append(chain)

    def texts(self, at: np.ndarray, size: int) -> list[bytes]:
        """The phrases of ``size`` words that begin at these words, space-joined."""
        w, inner = self.words, np.arange(1, size)
        raw = w.bytes.tobytes()
        found = [raw[a:b] for a, b in zip(w.start[at].tolist(), w.end[at + size - 1].tolist(), strict=True)]
        apart = (w.start[at[:, None] + inner] != w.end[at[:, None] + inner - 1] + 1).any(axis=1)  # more than one blank somewhere
        for i in np.flatnonzero(apart).tolist():
            found[i] = b" ".join(found[i].split())
        return [x.replace(b"\t", b" ") for x in found] if b"\t" in raw else found


def phrases_of(batch: pa.RecordBatch) -> Iterator[tuple[Phrases, np.ndarray, list[str]]]:
    """Phrases of slices of a batch (columns language and text), the language of each text as a number, and the languages."""
    names = batch.column(0).fill_null(UNKNOWN).dictionary_encode()
    languages = names.dictionary.to_pylist()
    codes = names.indices.to_numpy(zero_copy_only=False)
    salts = np.array([int.from_bytes(hashlib.blake2b(x.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big") for x in languages], np.uint64)
    data, offsets = utf8(batch.column(1))
    for a, b in slices(offsets, SLICE_BYTES):
        yield Phrases(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], salts[codes[a:b]]), codes[a:b], languages


def added(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and the sum of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class Summary:
    """A Misra-Gries summary: no count is more than ``taken`` below the truth, and what is missing has at most ``taken``.

    It holds ``capacity`` keys, or, with ``least``, at least one more than its mass divided by that. ``taken`` then stays
    below ``least``: a summary that could only shrink by taking more stays as it is.
    """

    def __init__(self, capacity: int, least: int | None = None) -> None:
        self.capacity, self.least, self.taken, self.mass = capacity, least, 0, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, keys: np.ndarray, counts: np.ndarray, taken: int = 0) -> None:
        self.keys, self.counts = added(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        self.taken += taken
        self.mass += int(counts.sum())
        capacity = max(self.capacity, self.mass // self.least + 1 if self.least else 0)
        if len(self.keys) > capacity:
            next_largest = len(self.counts) - 1 - capacity
            off = int(np.partition(self.counts, next_largest)[next_largest])
            if self.least is None or self.taken + off < self.least:
                left = self.counts > off
                self.keys, self.counts, self.taken = self.keys[left], self.counts[left] - off, self.taken + off

    def at_least(self, least: int) -> np.ndarray:
        """Keys whose true count may reach ``least``."""
        return self.keys[self.counts + self.taken >= least]


def _pack(keys: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    """Ascending 32-bit keys as differences, and counts; the first bytes of all, then the second ones, compressed."""
    steps = np.diff(keys, prepend=np.uint64(0)).astype("<u4").view(np.uint8).reshape(-1, 4)
    return tuple(bytes(pa.compress(x.tobytes(), codec="zstd", asbytes=True)) if len(keys) else b"" for x in (steps.T, counts.astype("<u4").view(np.uint8).reshape(-1, 4).T))


def _unpack(keys: bytes, counts: bytes, n: int) -> tuple[np.ndarray, np.ndarray]:
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    planes = [np.frombuffer(pa.decompress(x, decompressed_size=4 * n, codec="zstd"), np.uint8).reshape(4, n).T for x in (keys, counts)]
    steps, numbers = (np.ascontiguousarray(x).view("<u4").ravel() for x in planes)
    return np.cumsum(steps, dtype=np.uint64), numbers.astype(np.int64)


def place_of(hashes: np.ndarray, partitions: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash partition and key of phrases."""
    return (hashes >> np.uint64(32)) % np.uint64(partitions), hashes & _KEY


def summaries(texts: DataFrame, partitions: int) -> DataFrame:
    """``part, n, keys, counts``: packed summaries of hash partitions, some for each task."""

    def pack(hashes: list[np.ndarray]) -> pa.RecordBatch:
        part, key = place_of(np.concatenate(hashes), partitions)
        key |= part << np.uint64(32)
        distinct, counts = np.unique(key, return_counts=True)
        cuts = np.searchsorted(distinct, np.arange(partitions + 1, dtype=np.uint64) << np.uint64(32))
        rows = []
        for p in np.flatnonzero(np.diff(cuts)).tolist():
            keys, c = distinct[cuts[p] : cuts[p + 1]] & _KEY, counts[cuts[p] : cuts[p + 1]]
            rows.append((p, len(keys), *_pack(keys, c)))
        columns = list(zip(*rows, strict=True)) or [()] * 4
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["part", "n", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for found, _, _ in phrases_of(batch):
                held += found.hashes
                size += sum(map(len, found.hashes))
                if size >= TASK_PHRASES:
                    yield pack(held)
                    held, size = [], 0
        if size:
            yield pack(held)

    return texts.mapInArrow(run, "part int, n long, keys binary, counts binary")


def survivors(summed: DataFrame, partitions: int, least: int) -> DataFrame:
    """``place`` (partition and key in one number) of every phrase that may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[int, Summary] = {}
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = 0

        def fold() -> None:
            nonlocal size
            for p, pieces in held.items():
                merged.setdefault(p, Summary(CAPACITY, least)).merge(*(np.concatenate(x) for x in zip(*pieces, strict=True)))
            held.clear()
            size = 0

        for batch in batches:
            for p, n, keys, counts in zip(*(batch.column(i) for i in range(4)), strict=True):
                held.setdefault(p.as_py(), []).append(_unpack(keys.as_py(), counts.as_py(), n.as_py()))
                size += n.as_py()
                if size >= TASK_PHRASES:
                    fold()
        fold()
        for p, summary in merged.items():
            found = (np.uint64(p) << np.uint64(32)) | summary.at_least(least)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64))], names=["place"])

    # A task gets the summaries of one hash partition.
    return summed.repartitionById(partitions, F.col("part")).mapInArrow(run, "place long")


def _probes(places: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    for k in range(PROBES):
        yield mixed(places * np.uint64(2 * k + 3) + np.uint64(k)) & np.uint64(bits - 1)


def bit_table(found: DataFrame) -> np.ndarray:
    """64-bit words with the bits of all places; at most ``BITS_MOST`` bits reach the driver."""
    bits = BITS_LEAST
    wanted = BITS_EACH * found.count()
    while bits < min(wanted, BITS_MOST):
        bits *= 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(0).to_numpy().view(np.uint64)
            at = np.unique(np.concatenate([np.zeros(0, np.uint64), *_probes(places, bits)]))
            yield pa.RecordBatch.from_arrays([pa.array((at >> np.uint64(6)).view(np.int64)), pa.array((at & np.uint64(63)).astype(np.int32))], names=["word", "bit"])

    set_bits = found.mapInArrow(run, "word long, bit int").groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[set_bits.column("word").to_numpy()] = set_bits.column("bits").to_numpy().view(np.uint64)
    return table


def _met(hashes: np.ndarray, table: np.ndarray, partitions: int) -> np.ndarray:
    part, key = place_of(hashes, partitions)
    places = (part << np.uint64(32)) | key
    at = np.arange(len(places))
    for k in range(PROBES):
        probe = mixed(places[at] * np.uint64(2 * k + 3) + np.uint64(k)) & np.uint64(len(table) * 64 - 1)
        at = at[(table[probe >> np.uint64(6)] >> (probe & np.uint64(63))) & np.uint64(1) != 0]
    return at


_COUNTED = "lang string, phrase string, words int, c long"


def counted(texts: DataFrame, partitions: int, table: np.ndarray) -> DataFrame:
    """``lang, phrase, words, c``: sums over slices of phrases that meet the table; phrase null, words 0: all words."""
    shared = texts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            for found, codes, languages in phrases_of(batch):
                names = pa.array(languages, pa.string())
                totals = np.bincount(codes, weights=found.counts, minlength=len(languages)).astype(np.int64)
                nothing = pa.nulls(len(languages), pa.string())
                yield _rows(names, nothing, 0, totals)
                code_of_word = np.repeat(codes, found.counts)
                for k in range(LONGEST):
                    hashes, at = found.hashes[k], found.at[k]
                    hit = _met(hashes, bits, partitions)
                    _, first, c = np.unique(hashes[hit], return_index=True, return_counts=True)
                    at = at[hit[first]]
                    if len(at):
                        phrase = pa.array(found.texts(at, k + 1), pa.binary()).cast(pa.string())
                        yield _rows(names.take(pa.array(code_of_word[at])), phrase, k + 1, c)

    return texts.mapInArrow(run, _COUNTED)


def _rows(lang: pa.Array, phrase: pa.Array, words: int, c: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([lang, phrase, pa.array(np.full(len(c), words), pa.int32()), pa.array(c, pa.int64())], names=["lang", "phrase", "words", "c"])


def frequent_phrases(docs: DataFrame, least: int = LEAST, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, phrase, words, a`` of every phrase of 1 to ``LONGEST`` words with at least ``least`` occurrences, and a row per
    language without a phrase, 0 words and the number of all its words."""
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit(UNKNOWN)).alias("lang"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(width, -(-chars // PARTITION_MASS))  # about a phrase a character at most
    table = bit_table(staged(survivors(summaries(texts, partitions), partitions, least), "survivors"))
    found = counted(texts, partitions, table).groupBy("lang", "phrase", "words").agg(F.sum("c").alias("a"))
    return staged(found.where((F.col("words") == 0) | (F.col("a") >= least)), "frequent")


def _parts(words: Column, cut: Column) -> tuple[Column, Column]:
    size = F.size(words)
    return F.array_join(F.slice(words, F.lit(1), cut), " "), F.array_join(F.slice(words, cut + 1, size - cut), " ")


def _whole(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def scored(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of every phrase of two words or more, by its lowest cut."""
    cut = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")
    cuts = frequent.where("words > 1").select("lang", "phrase", "words", "a", cut)
    first, rest = _parts(F.split("phrase", " "), F.col("cut"))
    cuts = cuts.select("*", first.alias("first"), rest.alias("rest"))
    of = frequent.where("words > 0")
    lefts = of.select("lang", F.col("phrase").alias("first"), F.col("a").alias("l"))
    rights = of.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    joined = cuts.join(lefts, ["lang", "first"]).join(rights, ["lang", "rest"])
    score = F.expr(f"{SCALE}BD * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    lowest = F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("low")
    best = joined.groupBy("lang", "phrase", "words", "a").agg(lowest)
    return best.select("lang", "phrase", "words", "a", "low.l", "low.r", "low.score")


def held_in_longer(frequent: DataFrame) -> DataFrame:
    """``lang, phrase, most``: for every phrase of two words or more, the largest count of a longer phrase that holds it."""
    n = F.col("words")
    size = F.explode(F.sequence(F.lit(2), n - 1)).alias("size")
    sized = frequent.where("words > 2").select("lang", F.split("phrase", " ").alias("ws"), "words", "a", size)
    placed = sized.select("*", F.explode(F.sequence(F.lit(1), n - F.col("size") + 1)).alias("at"))
    inner = F.array_join(F.slice("ws", F.col("at"), F.col("size")), " ")
    return placed.groupBy("lang", inner.alias("phrase")).agg(F.max("a").alias("most"))


def collocations(docs: DataFrame, least: int = LEAST, kept: int = KEPT, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of each language's first ``kept`` phrases by score, count and phrase."""
    frequent = frequent_phrases(docs, least, text_col, lang_col)
    swallowed = F.coalesce(100 * _whole("most") >= SWALLOWED * _whole("a"), F.lit(False))
    left = scored(frequent).join(held_in_longer(frequent), ["lang", "phrase"], "left").where(~swallowed)
    rank = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    top = left.withColumn("rank", rank.cast("long")).where(F.col("rank") <= kept)
    totals = frequent.where("words = 0").select("lang", F.col("a").alias("n"))
    return top.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")

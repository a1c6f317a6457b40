"""Test items in documents, by pigeonhole pieces and bit-parallel edit distance.

A text is normalised: case folded, every stretch of white space one blank. An item of n characters may differ by
k = n // ``CHARS_PER_EDIT`` edits (insert, delete, replace a character). It is cut into k + 1 pieces; whatever the k
edits, one piece survives unchanged, so every match shows as an exact piece hit at about its place. All pieces are
looked up at once in one pass over the document. The stretch around a hit that could hold the item is then searched
with Myers' bit-parallel algorithm, and overlapping stretches of one item are searched once.

Items shorter than ``SHORTEST`` characters must stand unchanged, and not inside a longer word: where the characters on
both sides of an end are letters, marks or digits, the item does not match, unless one is of a script that writes no
blanks between words.

Distinct items are dealt by hash into blocks of about ``BLOCK_CHARS`` characters; one block after the other is sent to
the executors and passes over all documents. The driver and each worker hold the texts of one block at a time, two with
the worker's finders.

Null and empty texts on either side match nothing. Of several occurrences of an item in a document the one with the
smallest distance counts, then the first. Repeated rows each get their results; an item_id that comes with several
texts is looked for by each, and the best match counts. Positions are code points of the source, end exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce
from math import ceil

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebridge.llm.tables import staged

CHARS_PER_EDIT = 16
SHORTEST = 24
BLOCK_CHARS = 2_000_000

_WORD = re.compile(r"\S+")
#: Scripts without blanks between words: Thai to Myanmar, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")
Items = tuple[tuple[int, str], ...]


def normalise(text: str) -> str:
    return " ".join(text.split()).casefold()


def normalise_with_places(text: str) -> tuple[str, list[int]]:
    """The normalised text, and for each of its characters the position in the source."""
    parts: list[str] = []
    places: list[int] = []
    for word in text.split():
        start = text.index(word, places[-1] + 1 if places else 0)
        if parts:
            parts.append(" ")
            places.append(start - 1)
        folded = word.casefold()
        parts.append(folded)
        if len(folded) == len(word):
            places += range(start, start + len(word))
        else:
            places += [start + i for i, c in enumerate(word) for _ in c.casefold()]
    return "".join(parts), places


def edits_allowed(item: str) -> int:
    return len(item) // CHARS_PER_EDIT if len(item) >= SHORTEST else 0


def _in_word(text: str, at: int) -> bool:
    """Whether the place before ``text[at]`` lies inside a word."""
    if not 0 < at < len(text):
        return False
    sides = text[at - 1], text[at]
    return all(c.isalnum() or unicodedata.category(c)[0] == "M" for c in sides) and not any(_UNSPACED.match(c) for c in sides)


def pieces(item: str) -> list[tuple[int, str]]:
    """The item cut into one piece more than it may have edits, each with its offset."""
    n = edits_allowed(item) + 1
    cuts = [len(item) * i // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


def search(item: str, text: str) -> tuple[int, int]:
    """Least edit distance of the item to any stretch of the text, and the first end of such a stretch (Myers 1999)."""
    m = len(item)
    masks: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        masks[c] |= 1 << i
    every, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score = every, 0, m
    best, end = m, 0
    for j, c in enumerate(text):
        equal = masks.get(c, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        plus = down | (every & ~(across | up))
        minus = up & across
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best, end = score, j + 1
        plus <<= 1
        minus <<= 1
        up = (minus | ~(vertical | plus)) & every
        down = plus & vertical & every
    return best, end


def best_match(item: str, text: str, low: int, high: int) -> tuple[int, int, int]:
    """Distance, start and end of the best stretch of ``text[low:high]``."""
    at = text.find(item, low, high)
    if at >= 0:
        return 0, at, at + len(item)
    distance, end = search(item, text[low:high])
    end += low
    reach = max(low, end - len(item) - distance)
    _, back = search(item[::-1], text[reach:end][::-1])
    return distance, end - back, end


class Finder:
    """All items of a block in one automaton of pieces."""

    def __init__(self, items: Items) -> None:
        self.items = items
        self.short = [len(item) < SHORTEST for _, item in items]
        where: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for number, (_, item) in enumerate(items):
            for offset, piece in pieces(item):
                where[piece].append((number, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, uses in where.items():
            self.automaton.add_word(piece, (len(piece), uses))
        if where:
            self.automaton.make_automaton()
        self.some = bool(where)

    def matches(self, source: str | None) -> list[tuple[int, int, int, int]]:
        """``item_id, distance, start, end`` of every item in the text."""
        if not source or not self.some:
            return []
        text = normalise(source)
        diagonals: dict[int, set[int]] = defaultdict(set)
        found: dict[int, tuple[int, int, int]] = {}
        for last, (size, uses) in self.automaton.iter(text):
            for number, offset in uses:
                if not self.short[number]:
                    diagonals[number].add(last + 1 - size - offset)
                    continue
                match = 0, last + 1 - size, last + 1
                key = self.items[number][0]
                if (key not in found or match < found[key]) and not _in_word(text, match[1]) and not _in_word(text, match[2]):
                    found[key] = match
        for number, at in diagonals.items():
            key, item = self.items[number]
            k = edits_allowed(item)
            best: tuple[int, int, int] | None = None
            low = high = -1
            for d in [*sorted(at), None]:
                if d is not None and low >= 0 and d - k <= high:
                    high = min(len(text), d + len(item) + k)
                    continue
                if low >= 0:
                    match = best_match(item, text, low, high)
                    if match[0] <= k and (best is None or match[0] < best[0]):
                        best = match
                if d is not None:
                    low, high = max(0, d - k), min(len(text), d + len(item) + k)
            if best and (key not in found or best < found[key]):
                found[key] = best
        if not found:
            return []
        _, places = normalise_with_places(source)
        return [(key, distance, places[a], places[b - 1] + 1) for key, (distance, a, b) in sorted(found.items())]


@lru_cache(maxsize=2)
def _finder(items: Items) -> Finder:
    return Finder(items)


def find_items(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``id_col, item_id, distance, start, end`` of every document and item found in it."""
    spark = docs.sparkSession
    items = benchmark.where(F.col(item_text_col).isNotNull() & F.col(item_col).isNotNull())
    items = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    total = items.agg(F.sum(F.length("text").cast("long"))).first()[0] or 0
    blocks = max(1, ceil(total / BLOCK_CHARS))
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"{id_col} {kind}, row long, item_id long, distance int, start int, end int"
    texts = docs.select(id_col, F.col(text_col).alias("text"), (F.xxhash64(text_col) if blocks > 1 else F.lit(0).cast("long")).alias("row"))

    def one(block: int) -> DataFrame:
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        block_items = {(r["item_id"], normalise(r["text"])) for r in rows}
        shared = spark.sparkContext.broadcast(tuple(sorted(i for i in block_items if i[1])))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            finder = _finder(shared.value)
            for batch in batches:
                rows, found = [], []
                for i, text in enumerate(batch.column(1)):
                    for match in finder.matches(text.as_py()):
                        rows.append(i)
                        found.append(match)
                columns = list(zip(*found, strict=True)) or [()] * 4
                of = pa.array(rows, pa.int64())
                types = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
                matches = (pa.array(c, t) for c, t in zip(columns, types, strict=True))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(2).take(of), *matches], names=[id_col, "row", "item_id", "distance", "start", "end"])

        found = texts.mapInArrow(run, schema)
        if blocks > 1:  # this block goes before the next one comes
            found = staged(found.withColumn("block", F.lit(block)), f"block{block}")
            shared.destroy()
        return found

    every = reduce(DataFrame.unionAll, [one(b) for b in range(blocks)])
    if blocks > 1:  # texts of one item_id may be in several blocks; each has a match once for every row that repeats the document
        own = [F.col(c) for c in (id_col, "row", "item_id")]
        by_block = every.groupBy(*own, "block", "distance", "start", "end").count()
        best = by_block.groupBy(*own).agg(F.min(F.struct("distance", "start", "end", "block", "count")).alias("best"))
        every = best.select(id_col, "item_id", F.explode(F.expr("array_repeat(best, int(best.count))")).alias("best")).select(id_col, "item_id", "best.distance", "best.start", "best.end")
    return every.select(id_col, "item_id", "distance", "start", "end")

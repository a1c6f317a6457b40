"""Best-fit packing of documents into training sequences of several permitted lengths.

Lengths are counted in words (runs without white space) plus one separator a piece; any other count, such as tokens,
can be given as a column. A document longer than the largest capacity is cut into pieces of that capacity and a rest;
no word is dropped.

Pieces are dealt to shards by hash, about ``SHARD_PIECES`` to a shard, so that shards are packed side by side and the
loss at their edges stays small. Within a shard, pieces go from long to short into the open bin they fill best. When
none has room, the bin size is opened whose cost is least after crediting the room it leaves at a going rate. The
permitted lengths are optimised jointly: the shard is packed once with the going rate of each capacity, each bin
is cut down to the smallest capacity that holds its contents, and the cheapest packing is kept.

A sequence of length c costs ``c + c * c / QUADRATIC + OVERHEAD`` by default (linear work, attention, a fixed share).

Null, empty and blank texts have no words and no piece. Ties in length go by doc_id, then piece. Repeated rows are
packed each. A shard is worked on ``SHARD_LIMIT`` pieces at a time, should one id repeat without end.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable, Iterator, Sequence
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CAPACITIES = (256, 512, 1024, 2048, 4096)
QUADRATIC = 16_384
OVERHEAD = 16
SHARD_PIECES = 8_192
SHARD_LIMIT = 65_536


def default_cost(capacity: int) -> float:
    return capacity + capacity * capacity / QUADRATIC + OVERHEAD


def pack_once(lengths: Sequence[int], capacities: Sequence[int], costs: Sequence[float], rate: float) -> tuple[list[int], list[int]]:
    """Best fit, long to short (``lengths`` descending): bin of each piece, final contents of each bin."""
    room: list[tuple[int, int]] = []
    filled: list[int] = []
    place = []
    opens: dict[int, int] = {}
    for n in lengths:
        i = bisect_left(room, (n, -1))
        if i < len(room):
            left, b = room.pop(i)
        else:
            if n not in opens:
                fits = [k for k, c in enumerate(capacities) if c >= n]
                opens[n] = capacities[min(fits, key=lambda k: (costs[k] - rate * (capacities[k] - n), k))]
            left, b = opens[n], len(filled)
            filled.append(0)
        filled[b] += n
        place.append(b)
        if left > n:
            insort(room, (left - n, b))
    return place, filled


def pack(lengths: Sequence[int], capacities: Sequence[int], cost: Callable[[int], float]) -> tuple[list[int], list[int]]:
    """The cheapest packing over the going rates of all capacities: bin of each piece, capacity of each bin."""
    sizes = sorted(capacities)
    costs = [cost(c) for c in sizes]
    best: tuple[float, list[int], list[int]] | None = None
    for rate in sorted({c / s for c, s in zip(costs, sizes, strict=True)}):
        place, filled = pack_once(lengths, sizes, costs, rate)
        cut = [sizes[bisect_left(sizes, f)] for f in filled]
        total = sum(costs[bisect_left(sizes, c)] for c in cut)
        if best is None or total < best[0]:
            best = (total, place, cut)
    return (best[1], best[2]) if best else ([], [])


def word_count(text: Column) -> Column:
    """Runs of characters other than space and the controls 9 to 13; 0 for null."""
    parts = F.split(F.coalesce(text, F.lit("")), r"[\x09-\x0D\x20]+")
    blank = F.lit("")
    edges = F.when(parts[0] == blank, 1).otherwise(0) + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == blank), 1).otherwise(0)
    return F.size(parts) - edges


def pieces(docs: DataFrame, length: Column, largest: int, id_col: str) -> DataFrame:
    """``doc_id, piece, first, n``: pieces of at most ``largest`` units, one of them the separator."""
    step = largest - 1
    sized = docs.select(F.col(id_col).alias("doc_id"), length.cast("long").alias("size")).where("size > 0")
    cut = sized.select("doc_id", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / step))).alias("piece"))
    return cut.select("doc_id", "piece", (F.col("piece") * step).alias("first"), F.least(F.lit(step), F.col("size") - F.col("piece") * step).cast("int").alias("n"))


def pack_documents(
    docs: DataFrame,
    capacities: Sequence[int] = CAPACITIES,
    cost: Callable[[int], float] = default_cost,
    length: Column | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, piece, first_word, n_words, bin_id, capacity, slot``: where every piece of every document goes.

    ``slot`` is the piece's offset in its bin, separators counted; bin ids are unique.
    """
    capacities = tuple(sorted(set(capacities)))
    if not capacities or capacities[0] < 2:
        raise ValueError("capacities must be at least 2")
    shards = max(1, ceil(docs.count() / SHARD_PIECES))
    parts = min(shards, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cut = pieces(docs, word_count(F.col(text_col)) if length is None else length, capacities[-1], id_col)
    dealt = (
        cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(shards)))
        .repartition(parts, "shard")
        .sortWithinPartitions("shard", F.desc("n"), "doc_id", "piece")
    )

    def packed(rows: pa.Table, window: int) -> pa.RecordBatch:
        rows = rows.combine_chunks()
        lengths = rows.column("n").to_numpy() + 1
        place, sizes = pack(lengths.tolist(), capacities, cost)
        place_of, sizes_of = np.array(place), np.array(sizes)
        order = np.argsort(place_of, kind="stable")
        before = np.concatenate([[0], np.cumsum(lengths[order])[:-1]])
        firsts = np.concatenate([[True], place_of[order][1:] != place_of[order][:-1]])
        slot = np.empty(len(order), np.int64)
        slot[order] = before - np.maximum.accumulate(np.where(firsts, before, 0))
        shard = rows.column("shard")[0].as_py()
        bins = ((shard * (1 << 12) + window) << 17) + place_of
        columns = [rows.column(c).combine_chunks() for c in ("doc_id", "piece", "first", "n")]
        return pa.RecordBatch.from_arrays(
            [*columns, pa.array(bins, pa.int64()), pa.array(sizes_of[place_of], pa.int32()), pa.array(slot, pa.int32())],
            names=["doc_id", "piece", "first_word", "n_words", "bin_id", "capacity", "slot"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        shard, window, rows = None, 0, 0
        for batch in batches:
            of = batch.column("shard").to_numpy()
            cuts = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1), len(of)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if held and (of[a] != shard or rows >= SHARD_LIMIT):
                    yield packed(pa.Table.from_batches(held), window)
                    window = window + 1 if of[a] == shard else 0
                    held, rows = [], 0
                elif of[a] != shard:
                    window = 0
                shard = of[a]
                held.append(batch.slice(a, b - a))
                rows += b - a
        if held:
            yield packed(pa.Table.from_batches(held), window)

    kind = docs.schema[id_col].dataType.simpleString()
    return dealt.mapInArrow(run, f"doc_id {kind}, piece long, first_word long, n_words int, bin_id long, capacity int, slot int")

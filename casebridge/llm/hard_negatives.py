"""Hard negatives from a Hilbert-ordered table of vectors with zone maps.

Components are turned into integers, floor(scale * x). An anchor's positives are the rows of its own label with the largest
inner products. A hard negative of an anchor and a positive has another label and a product that is a given share of the
positive's: close, but not so close that its label is in doubt.

1. *Layout.* Rows are ordered by label, then along a Hilbert curve through the ``DIMENSIONS`` dimensions that vary most, and
   written as Parquet in blocks of ``BLOCK_ROWS`` rows. Rows of one place are told apart by id, so a frequent vector or label
   spreads over many blocks.
2. *Zone maps.* For each block, the smallest and largest value per dimension, and of the labels. A block read in two
   batches has two maps.
3. *Bounds.* With q the anchor's vector, the products of a block lie between the sums over the dimensions of the smaller and of the
   larger of q * least and q * most. A sample of about ``SAMPLE`` rows, scored by every anchor, gives a score that the
   last wanted row reaches; it only saves reading.
4. *Reading.* An anchor reads the blocks whose interval meets its bound (positives) or one of its windows (negatives), and
   that may hold a label it wants. Blocks nobody reads are not moved. Anchors are blocked as well, and up to 2 ** ``SHELF_BITS``
   blocks of rows stand on a shelf: a task holds a block of anchors and a shelf, an anchor comes once for all it reads
   there, with a bit for each block, and what may be among the first of a window is sent on. Products are made for ``ASK_ROWS`` anchors at a time.

Results are exact: bounds are tested with a slack above rounding, products are integers (in 64 bits).

Rows with a null id or label, a null vector, or a null or non-finite component take no part. Shorter vectors count as filled
up with zeros. Ties go to the smaller id. Rows of the anchor's own id are not its partners; repeated rows are partners
each; if an anchor's id repeats, the smallest label and vector asks. Fewer positives or negatives than wanted: all of them. An
empty table gives no rows. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from casebridge.llm.tables import staged

#: Dimensions of the curve and bits of each; together at most 62.
DIMENSIONS, LEVEL_BITS = 15, 4
#: Rows of a block: 2 ** BLOCK_BITS.
BLOCK_BITS = 10
SAMPLE = 2_048
#: Anchors in a block, and zone maps in a page.
ANCHOR_BLOCK, ZONE_PAGE = 2_048, 2_048
#: Blocks of a shelf: 2 ** SHELF_BITS, or fewer if they had more than SHELF_NUMBERS components.
SHELF_BITS, SHELF_NUMBERS = 4, 1 << 20
#: Anchors whose products with a block, a page or the sample are held at a time.
ASK_ROWS = 256


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places along the Hilbert curve of the rows of a matrix of coordinates of ``bits`` bits (Skilling's transposed form)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    for level in range(bits - 1, 0, -1):
        low = (1 << level) - 1
        for i in range(n):
            high = (x[i] >> level) & 1 == 1
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0]) ^ swap
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[n - 1] >> level) & 1 == 1, (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> level & 1)
    return key


def matrix(column: pa.Array | pa.ChunkedArray, width: int, fill: float = 0, kind: type = np.int64) -> np.ndarray:
    """A list column as a matrix (of integers), short rows filled up (with zeros)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    out = np.full((len(column), width), fill, kind)
    if len(column):
        sizes = column.value_lengths().to_numpy(zero_copy_only=False)
        out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def products(asked: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products, a row for each asked vector: in floating point where every partial sum is an exact integer."""
    largest = float(np.abs(rows).max(initial=0)) * float(np.abs(asked).max(initial=0)) * max(1, rows.shape[1])
    if largest < 2**52:
        return np.rint(asked.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return asked @ rows.T


def intervals(asked: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds below and above of the products of each asked vector with rows between ``least`` and ``most``."""
    q, least, most = (x.astype(np.float64) for x in (asked, least, most))
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    slack = 1e-9 * (np.abs(q) @ np.maximum(np.abs(least), np.abs(most)).T)
    return up @ least.T + down @ most.T - slack, up @ most.T + down @ least.T + slack


def _lists(rows: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel()))


def integer_rows(embeddings: DataFrame, scale: int, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, v`` (longs) of the rows that take part."""
    x = F.col(vec_col)
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    rows = embeddings.where(x.isNotNull() & F.col(id_col).isNotNull() & F.col(label_col).isNotNull()).where(finite)
    vector = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("long"))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), vector.alias("v"))


class Sample:
    """Some rows: what the curve is laid through, and scores that the wanted rows reach at least."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        self.ids, self.labels, self.vectors = ids, labels, vectors
        spread = vectors.std(axis=0) if len(ids) else np.zeros(vectors.shape[1])
        self.dimensions = np.argsort(-spread, kind="stable")[:DIMENSIONS]
        self.middle = vectors[:, self.dimensions].mean(axis=0) if len(ids) else np.zeros(len(self.dimensions))
        self.unit = np.maximum(spread[self.dimensions], 1e-9) * 4 / (1 << LEVEL_BITS)  # levels cover two deviations to each side

    def keys(self, vectors: np.ndarray) -> np.ndarray:
        if not len(self.dimensions):
            return np.zeros(len(vectors), np.int64)
        top = (1 << LEVEL_BITS) - 1
        level = np.floor((vectors[:, self.dimensions] - self.middle) / self.unit) + (top + 1) // 2
        return hilbert_keys(np.clip(level, 0, top).astype(np.int64), LEVEL_BITS)


def kth_largest(scores: np.ndarray, k: int) -> float:
    """The k-th largest score, or no bound if there are fewer."""
    return float(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else -np.inf


def lay_out(rows: DataFrame, sample: Sample, width: int) -> DataFrame:
    """The rows in blocks along the curve, as a written table ``vec_id, label, v, block``."""
    shared = rows.sparkSession.sparkContext.broadcast(sample)

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = shared.value.keys(matrix(batch.column(2), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place)], names=["vec_id", "label", "v", "place"])

    order = ("label", "place", "vec_id")
    placed = rows.mapInArrow(key, "vec_id long, label long, v array<long>, place long").repartitionByRange(*order).sortWithinPartitions(*order)
    return staged(placed.select("vec_id", "label", "v", F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("block")), "index")


def zone_maps(index: DataFrame, width: int) -> DataFrame:
    """``block, first, last, least, most``: labels and values per dimension of each block, or of a part of it read at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block, label, v = batch.column(3).to_numpy(), batch.column(1).to_numpy(), matrix(batch.column(2), width)
            if not len(block):
                continue
            at = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            columns = [pa.array(block[at])] + [pa.array(f.reduceat(label, at)) for f in (np.minimum, np.maximum)]
            zones = [_lists(f.reduceat(v, at, axis=0)) if width else pa.array([[]] * len(at), pa.list_(pa.int64())) for f in (np.minimum, np.maximum)]
            yield pa.RecordBatch.from_arrays([*columns, *zones], names=["block", "first", "last", "least", "most"])

    return index.mapInArrow(run, "block long, first long, last long, least array<long>, most array<long>")


#: What an anchor asks for: ranges of products, each with a number, the label it is about and whether that label is wanted or not.
_ASK = "anchor_id long, label long, q array<long>, part array<int>, low array<double>, high array<double>"


def asked_ranges(asked: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number, least and largest product of each anchor's ranges, in a row; rows with fewer are filled up with ranges that hold nothing."""
    width = max(pc.max(pc.list_value_length(asked.column("part"))).as_py() or 0, 1) if len(asked) else 1
    return matrix(asked.column("part"), width), matrix(asked.column("low"), width, np.inf, np.float64), matrix(asked.column("high"), width, -np.inf, np.float64)


def shelf_bits(width: int) -> int:
    return min(SHELF_BITS, max(1, (SHELF_NUMBERS >> BLOCK_BITS) // max(width, 1)).bit_length() - 1)


def visits(asked: DataFrame, zones: DataFrame, width: int, same: bool, anchor_blocks: int, pages: int) -> DataFrame:
    """The blocks each anchor must read: rows of ``asked`` with ``anchor_block``, and with ``shelves`` and the ``blocks`` of each as bits.

    ``same``: rows of the anchor's own label are wanted, else those of others.
    """
    bits = shelf_bits(width)
    left = asked.withColumn("anchor_block", F.pmod(F.xxhash64("anchor_id"), F.lit(anchor_blocks)).cast("int"))
    left = left.withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1))))
    right = zones.withColumn("page", F.pmod(F.xxhash64(F.shiftright("block", bits)), F.lit(pages)).cast("int"))
    right = right.withColumn("anchor_block", F.explode(F.sequence(F.lit(0), F.lit(anchor_blocks - 1))))

    def choose(anchors: pa.Table, maps: pa.Table) -> pa.Table:
        maps = maps.sort_by("block")
        block, first, last = (maps.column(c).to_numpy() for c in ("block", "first", "last"))
        least, most, q = matrix(maps.column("least"), width), matrix(maps.column("most"), width), matrix(anchors.column("q"), width)
        label, (_, lows, highs) = anchors.column("label").to_numpy()[:, None], asked_ranges(anchors)
        starts = np.flatnonzero(np.concatenate([[True], np.diff(block >> bits) != 0])) if len(block) else np.zeros(0, np.int64)
        bit = (1 << (block & ((1 << bits) - 1))).astype(np.int32)
        read = np.zeros((len(q), len(starts)), np.int32)
        for at in range(0, len(q) if len(block) else 0, ASK_ROWS):
            some = slice(at, at + ASK_ROWS)
            low, high = intervals(q[some], least, most)
            meets = np.zeros(low.shape, bool)
            for a, b in zip(lows[some].T, highs[some].T, strict=True):
                meets |= (high >= a[:, None]) & (low <= b[:, None])
            meets &= (first <= label[some]) & (label[some] <= last) if same else (first != label[some]) | (last != label[some])
            read[some] = np.bitwise_or.reduceat(np.where(meets, bit, 0), starts, axis=1)
        at, place = np.nonzero(read)
        some, sizes = np.unique(at, return_counts=True)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        table = anchors.drop_columns(["page"]).take(pa.array(some)).select(["anchor_block", "anchor_id", "label", "q", "part", "low", "high"])
        lists = (pa.ListArray.from_arrays(ends, pa.array(x)) for x in ((block >> bits)[starts][place], read[at, place]))
        return table.append_column("shelves", next(lists)).append_column("blocks", next(lists))

    keys = ("anchor_block", "page")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(choose, f"anchor_block int, {_ASK}, shelves array<long>, blocks array<int>")


def first_of_each(group: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k largest scores of each group, ties to the smaller id."""
    order = np.lexsort((ids, -scores, group))
    starts = np.flatnonzero(np.concatenate([[True], np.diff(group[order]) != 0])) if len(order) else order
    return order[np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order)))) < k]


def read_blocks(index: DataFrame, wanted: DataFrame, width: int, same: bool, k: int) -> DataFrame:
    """``anchor_id, part, vec_id, score``: of every shelf read, the first k rows of each range."""
    bits = shelf_bits(width)
    wanted = staged(wanted, "visits")
    each = wanted.withColumn("on", F.explode(F.arrays_zip("shelves", "blocks"))).drop("shelves", "blocks")
    asking = each.select("*", F.col("on.shelves").alias("shelf"), F.col("on.blocks").alias("blocks")).drop("on")
    readers = asking.groupBy(F.col("shelf").alias("read"), F.col("anchor_block").alias("reader")).agg(F.bit_or("blocks").alias("any"))
    bit = F.call_function("shiftleft", F.lit(1), F.col("block").bitwiseAND((1 << bits) - 1).cast("int"))
    met = index.join(readers, F.shiftright("block", bits) == readers.read).where(F.col("any").bitwiseAND(bit) != 0).drop("any")

    def search(rows: pa.Table, asked: pa.Table) -> pa.Table:
        ids, labels, block = (rows.column(c).to_numpy() for c in ("vec_id", "label", "block"))
        anchor, own, reads = (asked.column(c).to_numpy() for c in ("anchor_id", "label", "blocks"))
        v, q, (part, lows, highs) = matrix(rows.column("v"), width), matrix(asked.column("q"), width), asked_ranges(asked)
        lowest, highest, ranges = lows.min(axis=1), highs.max(axis=1), lows.shape[1]
        found = [np.zeros((3, 0), np.int64)]
        for b in np.unique(block):
            here = np.flatnonzero(block == b)
            asks = np.flatnonzero(reads >> (b & ((1 << bits) - 1)) & 1)
            for at in range(0, len(asks), ASK_ROWS):
                some = asks[at : at + ASK_ROWS]
                scores = products(q[some], v[here])
                near = (scores >= lowest[some, None]) & (scores <= highest[some, None])
                near &= ((labels[here] == own[some, None]) == same) & (ids[here] != anchor[some, None])
                i, j = np.nonzero(near)
                of, score, name = some[i], scores[i, j], ids[here[j]]
                for p in range(ranges):
                    inside = np.flatnonzero((score >= lows[of, p]) & (score <= highs[of, p]))
                    best = inside[first_of_each(of[inside], name[inside], score[inside], k)]
                    found.append(np.stack([of[best] * ranges + p, name[best], score[best]]))
        place, name, score = np.concatenate(found, axis=1)
        best = first_of_each(place, name, score, k)
        of, p = np.divmod(place[best], ranges)
        return pa.table({"anchor_id": anchor[of], "part": pa.array(part[of, p], pa.int32()), "vec_id": name[best], "score": score[best]})

    return met.groupBy("reader", "read").cogroup(asking.groupBy("anchor_block", "shelf")).applyInArrow(search, "anchor_id long, part int, vec_id long, score long")


def _asks(anchors: DataFrame, sample: Sample, width: int, ranges: Callable) -> DataFrame:
    """``_ASK`` of anchors: ``ranges(label, positives, scores, same)`` gives part, low and high from the sample's scores."""
    shared = anchors.sparkSession.sparkContext.broadcast(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        for batch in (whole.slice(at, ASK_ROWS) for whole in batches for at in range(0, len(whole), ASK_ROWS)):
            scores = products(matrix(batch.column(2), width), s.vectors)
            found = []
            for i, (anchor, label, positives) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist(), strict=True)):
                other = s.ids != anchor
                found.append(ranges(positives, scores[i][other & (s.labels == label)], scores[i][other & (s.labels != label)]))
            lists = [pa.array([f[c] for f in found], pa.list_(t)) for c, t in enumerate((pa.int32(), pa.float64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], names=["anchor_id", "label", "q", "part", "low", "high"])

    return anchors.mapInArrow(run, _ASK)


def _ranked(found: DataFrame, by: tuple[str, ...], k: int) -> DataFrame:
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def hard_negatives(
    embeddings: DataFrame,
    asks: Column,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    scale: int = 256,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows where ``asks`` (on ``vec_id``) holds.

    ``window``: the share (percent) of the positive's product that a negative's product has.
    """
    rows = staged(integer_rows(embeddings, scale, id_col, vec_col, label_col), "vectors")
    facts = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width = facts["width"] or 0
    share = int(min(1.0, SAMPLE / max(facts["n"], 1)) * (1 << 20))
    picked = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 20)) < share).limit(4 * SAMPLE).toArrow()
    sample = Sample(picked.column("vec_id").to_numpy(), picked.column("label").to_numpy(), matrix(picked.column("v"), width))

    index = lay_out(rows, sample, width)
    zones = staged(zone_maps(index, width), "zones")
    chosen = rows.where(asks).groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("own"))
    anchors = staged(chosen.select(F.col("vec_id").alias("anchor_id"), "own.label", F.col("own.v").alias("q")), "anchors")
    anchor_blocks, pages = max(1, ceil(anchors.count() / ANCHOR_BLOCK)), max(1, ceil(zones.count() / ZONE_PAGE))

    def best(_: object, same: np.ndarray, other: np.ndarray) -> tuple[list, list, list]:
        return [0], [kth_largest(same, positives)], [np.inf]

    nobody = F.array().cast("array<struct<rank: int, score: long>>")
    first = visits(_asks(anchors.withColumn("positives", nobody), sample, width, best), zones, width, True, anchor_blocks, pages)
    near = staged(_ranked(read_blocks(index, first, width, True, positives), ("anchor_id",), positives), "positives")

    share_low, share_high = window

    def windows(found: list[dict], same: np.ndarray, other: np.ndarray) -> tuple[list, list, list]:
        parts, lows, highs = [], [], []
        for p in found:
            low, high = -(-share_low * p["score"] // 100), share_high * p["score"] // 100
            if low <= high:
                inside = other[(other >= low) & (other <= high)]
                parts, lows, highs = [*parts, p["rank"]], [*lows, max(float(low), kth_largest(inside, negatives))], [*highs, float(high)]
        return parts, lows, highs

    of_anchor = near.groupBy("anchor_id").agg(F.collect_list(F.struct("rank", "score")).alias("positives"))  # at most `positives` each
    second = visits(_asks(anchors.join(of_anchor, "anchor_id"), sample, width, windows), zones, width, False, anchor_blocks, pages)
    hard = _ranked(read_blocks(index, second, width, False, negatives), ("anchor_id", "part"), negatives)
    partner = near.select("anchor_id", F.col("rank").alias("part"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = hard.select("anchor_id", "part", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    return named.join(partner, ["anchor_id", "part"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")

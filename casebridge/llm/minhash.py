"""Near duplicates by b-bit MinHash, with links confirmed on full shingle sets.

A document's set holds the hashes of its distinct runs of ``WIDTH`` words (bytes without white space, A-Z in lower
case). The steps, each over all documents:

1. *Sketch.* ``MINIMA`` minima of random permutations of the set. Their low ``BITS`` bits are packed into the
   signature; runs of ``ROWS`` full minima make ``BANDS`` band keys.
2. *Classes.* Documents with the same set form a class (map-side combined), and its smallest doc_id stands for it.
3. *Buckets.* Representatives that share a band key. Inside a bucket, signatures are compared by bit counts. An
   agreement by chance has probability 2^-b, which the estimate takes off. Pairs estimated below the threshold by
   ``MARGIN`` or more are dropped; the others are not written out but folded into stars around the smallest member.
4. *Families.* Components of those stars. Linked documents are always in one family.
5. *Confirmation.* The sets of a family are intersected exactly and the links folded into stars again; the
   components of these are the result.

Buckets and families that are larger than a block are cut into blocks, and each pair of blocks is a cell of its own,
so that a hot group spreads over many tasks; no task holds more than two blocks. The number of rows written is a
member's share of blocks, never all pairs.

With 20 bands of 4 rows, a pair right at 0.85 shares no band with probability 4e-7, less above; the margin of 5
standard errors loses up to 3e-6 more (binomial tail). Set hashes have 64 bits, class keys 128 and the size.

Null, empty and blank texts have empty sets, are their own component and kept. Rows that repeat a doc_id: each row
follows the class of its own text, which ``text_key`` (its hash) names. Very long texts are read whole, an empty table gives no
rows. Columns other than id and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebridge.llm.graph import components, local_roots
from casebridge.llm.tables import split_by_ids, staged
from casebridge.llm.words import LOWER_ASCII, NOT_SPACE, Words, mixed, shingles, slices, utf8

WIDTH = 5
#: Links: 100 * intersection >= PERCENT * union.
PERCENT = 85
MINIMA, BITS, BANDS, ROWS = 160, 4, 20, 4
#: Five standard errors of the estimate at the threshold: sqrt(J'(1 - J') / MINIMA) / (1 - 2^-BITS), J' with chance.
MARGIN = 0.15
#: Rows in a block of a bucket (signatures) and of a family (texts), and the set entries a family's block may have.
BUCKET_ROWS, FAMILY_ROWS, FAMILY_ENTRIES = 256, 128, 400_000
SLICE_BYTES = 1 << 18

_random = np.random.default_rng(20240229)
_FACTORS = _random.integers(0, 1 << 64, MINIMA, dtype=np.uint64) | np.uint64(1)
_OFFSETS = _random.integers(0, 1 << 64, MINIMA, dtype=np.uint64)
_NIBBLES = np.uint64(0x1111111111111111)


def document_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted set of each text of a column."""
    data, offsets = utf8(column)
    for a, b in slices(offsets, SLICE_BYTES):
        words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], NOT_SPACE, LOWER_ASCII)
        for i in range(b - a):
            yield np.unique(shingles(words.hash[words.of_text[i] : words.of_text[i + 1]], WIDTH))


def minima(entries: np.ndarray) -> np.ndarray:
    found = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(entries), 2048):
        np.minimum(found, (entries[i : i + 2048, None] * _FACTORS + _OFFSETS).min(axis=0), out=found)
    return found


def packed(found: np.ndarray) -> np.ndarray:
    """Low bits of the minima, 16 to a word."""
    low = (found & np.uint64((1 << BITS) - 1)).reshape(-1, 64 // BITS)
    return np.bitwise_or.reduce(low << np.arange(0, 64, BITS, dtype=np.uint64), axis=1)


def band_keys(found: np.ndarray) -> np.ndarray:
    rows = found[: BANDS * ROWS].reshape(BANDS, ROWS)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for j in range(ROWS):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return key


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Similarities estimated from one signature and a matrix of signatures, agreement by chance taken off."""
    differ = one ^ many
    differ |= differ >> np.uint64(2)
    differ |= differ >> np.uint64(1)
    same = 1 - np.bitwise_count(differ & _NIBBLES).sum(axis=-1) / MINIMA
    chance = 2.0**-BITS
    return (same - chance) / (1 - chance)


def _lists(values: list[np.ndarray], width: int) -> pa.ListArray:
    flat = np.concatenate(values) if values else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(np.arange(len(values) + 1, dtype=np.int32) * width, pa.array(flat.view(np.int64)))


def sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text_key, n, low, high`` (size and hash of the set), ``bands``, ``sig`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, keys, bands, sigs = [], [], [], []
            for entries in document_sets(batch.column(1)):
                found = minima(entries)
                n.append(len(entries))
                keys.append((entries.sum(dtype=np.uint64), np.bitwise_xor.reduce(mixed(entries * np.uint64(3)), initial=0)))
                bands.append(band_keys(found))
                sigs.append(packed(found))
            key = np.array(keys, np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64()), pa.array(key[:, 0]), pa.array(key[:, 1]), _lists(bands, BANDS), _lists(sigs, MINIMA * BITS // 64)],
                names=["doc_id", "text_key", "n", "low", "high", "bands", "sig"],
            )

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key"))
    return rows.mapInArrow(run, "doc_id long, text_key long, n long, low long, high long, bands array<long>, sig array<long>")


def _cells(rows: DataFrame, group: str, member: str, blocks: Column) -> DataFrame:
    """Each row once for every cell (pair of blocks of its group, its own with each) it belongs to, ``side`` its own block."""
    own = F.pmod(F.xxhash64(member, group), F.col("blocks")).cast("int")
    return (
        rows.withColumn("blocks", blocks)
        .withColumn("side", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("cell", F.struct(F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j")))
        .drop("blocks", "other")
    )


def _by_cell(rows: DataFrame, group: str, fold: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Run ``fold`` over each cell's rows; it gives links as two columns of ids (``a``, ``b``)."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    number = F.expr("cell.j * (cell.j + 1) / 2 + cell.i").cast("long")
    place = F.pmod(F.xxhash64(group) + number, F.lit(parts)).cast("int")  # the cells of a group go round
    dealt = rows.repartitionById(parts, place).sortWithinPartitions(group, "cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(table: pa.Table) -> pa.RecordBatch:
            a, b = fold(table)
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

        held: list[pa.RecordBatch] = []
        for batch in batches:
            key = np.stack([batch.column(group).to_numpy(), *(batch.column("cell").field(k).to_numpy(zero_copy_only=False) for k in (0, 1))])
            if not key.shape[1]:
                continue
            if held:
                last = held[-1].slice(held[-1].num_rows - 1)
                before = [last.column(group)[0].as_py(), *last.column("cell")[0].as_py().values()]
                if before != key[:, 0].tolist():
                    yield out(pa.Table.from_batches(held))
                    held = []
            cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1
            for a, b in zip([0, *cuts], [*cuts, key.shape[1]], strict=True):
                if a:
                    yield out(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(a, b - a))
        if held:
            yield out(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a long, b long")


def _stars(ids: np.ndarray, left: list[np.ndarray], right: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Links between places folded to one link per linked place, with the first place of its local component."""
    root = local_roots(len(ids), np.concatenate([np.zeros(0, np.int64), *left]), np.concatenate([np.zeros(0, np.int64), *right]))
    linked = np.flatnonzero(root != np.arange(len(ids)))
    return ids[root[linked]], ids[linked]


def _sorted_cell(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, bool]:
    table = table.combine_chunks().sort_by("doc_id")
    side = table.column("side").to_numpy()
    return table, table.column("doc_id").to_numpy(), side, bool((side != side[0]).any())


def _close_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Stars of the pairs of a cell whose estimate leaves a link possible."""
    least = PERCENT / 100 - MARGIN
    table, ids, side, two = _sorted_cell(table)
    sig = table.column("sig").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
    left, right = [], []
    for i in range(len(ids) - 1):
        near = np.flatnonzero(estimates(sig[i], sig[i + 1 :]) >= least) + i + 1
        if two:
            near = near[side[near] != side[i]]
        left.append(np.full(len(near), i))
        right.append(near)
    return _stars(ids, left, right)


def links_between(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of places whose sets meet the threshold, by counting shared entries."""
    sizes = np.array([len(s) for s in sets])
    entry, place = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(place, kind="stable")
    holders, begin = owner[order], np.searchsorted(place[order], np.arange(len(entry) + 1))
    ends = np.cumsum(sizes)
    left, right = [], []
    for i in range(len(sets) - 1):
        mine = place[ends[i] - sizes[i] : ends[i]]
        a, b = begin[mine], begin[mine + 1]
        counts = b - a
        many = counts > 1
        a, counts = a[many], counts[many]
        if not len(a):
            continue
        at = np.repeat(a - np.concatenate([[0], np.cumsum(counts)[:-1]]), counts) + np.arange(counts.sum())
        shared = np.bincount(holders[at], minlength=len(sets))
        shared[: i + 1] = 0
        linked = np.flatnonzero((shared > 0) & (100 * shared >= PERCENT * (sizes[i] + sizes - shared)))
        left.append(np.full(len(linked), i))
        right.append(linked)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _linked_pairs(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    table, ids, side, two = _sorted_cell(table)
    if len(ids) < 2:
        return ids[:0], ids[:0]
    left, right = links_between(list(document_sets(table.column("text").combine_chunks())))
    if two:
        across = side[left] != side[right]
        left, right = left[across], right[across]
    return _stars(ids, [left], [right])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` of every row."""
    sketches = staged(sketch(docs, id_col, text_col), "sketches")
    classes = sketches.where("n > 0").groupBy("n", "low", "high").agg(F.min(F.struct("doc_id", "bands", "sig")).alias("first"))
    reps = staged(classes.select("n", "low", "high", "first.*"), "classes")

    banded = reps.select("doc_id", F.explode("bands").alias("band"))
    crowded = banded.groupBy("band").agg(F.count("*").alias("members")).where("members > 1")
    members = banded.join(crowded, "band").join(reps.select("doc_id", "sig"), "doc_id")
    close = _by_cell(_cells(members, "band", "doc_id", F.ceil(F.col("members") / BUCKET_ROWS).cast("int")), "band", _close_pairs)
    families = components(staged(close.distinct(), "close"))

    sized = families.join(reps.select(F.col("doc_id").alias("node"), "n"), "node")
    total = sized.groupBy("label").agg(F.greatest(F.ceil(F.count("*") / FAMILY_ROWS), F.ceil(F.sum("n") / FAMILY_ENTRIES)).cast("int").alias("blocks"))
    place = staged(families.join(total, "label").select(F.col("node").alias("doc_id"), F.col("label").alias("family"), "blocks"), "families")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    chosen = split_by_ids(texts, place, "doc_id")[0].join(place, "doc_id")
    linked = components(staged(_by_cell(_cells(chosen, "family", "doc_id", F.col("blocks")), "family", _linked_pairs).distinct(), "linked"))

    labelled = reps.select("n", "low", "high", "doc_id").join(linked, F.col("doc_id") == F.col("node"), "left")
    classed = labelled.select("n", "low", "high", F.coalesce("label", "doc_id").alias("component_id"))
    found = sketches.select("doc_id", "text_key", "n", "low", "high").join(classed, ["n", "low", "high"], "left")
    component = F.coalesce("component_id", "doc_id")
    return found.select("doc_id", "text_key", F.col("n").alias("n_shingles"), component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))

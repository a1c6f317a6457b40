"""Near duplicates by SimHash, found through deletion-variant signatures.

A text's fingerprint has 64 bits: bit i is 1 where more than half of its shingles' hashes have bit i. Fingerprints link
at ``BITS`` (3) or fewer differing bits; a component holds everything reachable over links.

1. *Fingerprints.* Runs of ``WIDTH`` words (A-Z in lower case, cut at white space), repeats included, space-joined, with
   XXH64 of their UTF-8 bytes. A shorter text is one shingle; a text without words has fingerprint 0.
2. *Classes.* Rows of one fingerprint are one class, so exact copies cost one row from here on.
3. *Variants.* The fingerprint is cut into ``SEGMENTS`` (2) segments of 32 bits, fewer than the 4 that exact pieces would
   need: of 3 differing bits at most one falls into one of them. Each segment is written once per bit with that bit
   as a wildcard. Segments that are equal but for one bit share the variant of that bit, equal ones all of them.
4. *Equality join.* Variants are grouped. A variant of two classes is a pair and is tested in place; one of more has its
   members brought together in blocks. Each pair of blocks is a cell of its own (``CELL_ROWS``), so a hot variant spreads
   over many tasks, and no task holds more than two blocks. Links of a cell leave it as stars, never as all pairs.
5. *Components* of the links.

No link is lost: steps 3 to 5 are exact. m classes within few bits of each other are compared in m * m / 2 tests of two
machine words, in (m / CELL_ROWS)^2 / 2 cells.

Null, empty and blank texts have fingerprint 0 and are linked like any other. Rows that repeat an id each follow the
class of their own text; a component's id is the smallest id of its rows (null if all are null). Very long texts are read
whole, a bounded run of shingles at a time. An empty table gives no rows. Columns other than id and text are not read,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebridge.llm.graph import components, local_roots
from casebridge.llm.tables import split_by_ids, staged

WIDTH = 3
SEED = 42
#: Differing bits up to which fingerprints link; with two segments at most 3.
BITS = 3
SEGMENTS, SEGMENT_BITS = 2, 32
#: Classes in a block of a crowded variant.
CELL_ROWS = 1024
#: Links found before they are folded.
FOLD = 1 << 20
#: Shingles hashed and counted at a time.
RUN = 1 << 15


def shingle_hashes(text: str | None) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of a text, in runs."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    width = min(WIDTH, len(words))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    for i in range(0, len(first), RUN):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(first[i : i + RUN], last[i : i + RUN], strict=True)], np.uint64)


def fingerprint(text: str | None) -> int:
    """The fingerprint as an unsigned number."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text):
        total += len(hashes)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    set_bits = np.packbits(2 * ones > total, bitorder="little")
    return int(set_bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` of every row, the fingerprint as a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py()) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def variants(classes: DataFrame) -> DataFrame:
    """``fp`` and ``variant``: every segment with one bit as a wildcard, and which segment and bit."""
    n = F.col("n")
    segment = F.expr("shiftrightunsigned(fp, n div {0} * {0}) & 4294967295L".format(SEGMENT_BITS))
    wild = F.expr(f"~shiftleft(1L, n % {SEGMENT_BITS})")
    numbered = classes.select("fp", F.explode(F.sequence(F.lit(0), F.lit(SEGMENTS * SEGMENT_BITS - 1))).alias("n"))
    return numbered.select("fp", F.expr(f"shiftleft(cast(n as bigint), {SEGMENT_BITS})").bitwiseOR(segment.bitwiseAND(wild)).alias("variant"))


def _differing(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def stars(cell: np.ndarray, fps: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of one cell (rows sorted by cell), folded to one per linked row and cell with the first row reached.

    In a cell of two blocks (``side``) only pairs across are tested; each block has a cell of its own. Rows meet those 1, 2,
    3 ... places further on for as long as these are in the same cell, all cells of a batch at a time.
    """
    n = len(fps)
    first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if n else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[first, n])
    mixed = np.repeat(np.minimum.reduceat(side, first) != np.maximum.reduceat(side, first), sizes) if n else np.zeros(0, bool)
    root, at, step = np.arange(n), np.arange(n), 0
    left: list[np.ndarray] = []
    right: list[np.ndarray] = []
    while len(at):
        step += 1
        at = at[at + step < n]
        at = at[cell[at] == cell[at + step]]
        near = np.bitwise_count(fps[at].view(np.uint64) ^ fps[at + step].view(np.uint64)) <= BITS
        near &= ~mixed[at] | (side[at] != side[at + step])
        left.append(at[near])
        right.append(at[near] + step)
        if sum(map(len, left)) > FOLD or not len(at):
            # links so far go on as one link per row with its root
            root = local_roots(n, np.concatenate([root, *left]), np.concatenate([np.arange(n), *right]))
            left, right = [], []
    linked = np.flatnonzero(root != np.arange(n))
    return fps[root[linked]], fps[linked]


def _crowded_links(members: DataFrame) -> DataFrame:
    """Links ``a, b`` among the members of each variant (``variant, fp, members``), cell by cell."""
    blocks = F.ceil(F.col("members") / CELL_ROWS).cast("int")
    cells = (
        members.withColumn("blocks", blocks)
        .withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("variant", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "fp", "side")
    )
    dealt = cells.repartition("variant", "i", "j").sortWithinPartitions("variant", "i", "j")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros(0, np.int64)] * 5
        for batch in batches:
            held = [np.concatenate([h, batch.column(c).to_numpy()]) for c, h in enumerate(held)]
            cut = _last_cell(held)
            yield _links_batch([h[:cut] for h in held])
            held = [h[cut:] for h in held]
        yield _links_batch(held)

    return dealt.mapInArrow(run, "a long, b long")


def _last_cell(columns: list[np.ndarray]) -> int:
    """Where the last cell of the rows, which may go on in the next batch, begins."""
    variant, i, j = columns[:3]
    other = np.flatnonzero((variant != variant[-1:]) | (i != i[-1:]) | (j != j[-1:]))
    return int(other[-1]) + 1 if len(other) else 0


def _links_batch(columns: list[np.ndarray]) -> pa.RecordBatch:
    variant, i, j, fps, side = columns
    new = (variant[1:] != variant[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    a, b = stars(np.concatenate([np.zeros(min(1, len(fps)), np.int64), np.cumsum(new)]), fps, side)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links(classes: DataFrame) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that make the same components as all links."""
    keyed = variants(classes)
    met = staged(keyed.groupBy("variant").agg(F.count("*").alias("members"), F.min("fp").alias("a"), F.max("fp").alias("b")).where("members > 1"), "variants")
    pairs = met.where("members = 2").where(_differing(F.col("a"), F.col("b")) <= BITS).select("a", "b")
    crowded = met.where("members > 2").select("variant", "members")
    maybe, _ = split_by_ids(keyed, crowded, "variant")
    return pairs.unionByName(_crowded_links(maybe.join(crowded, "variant"))).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` of every row."""
    rows = staged(fingerprints(docs, id_col, text_col), "fingerprints")
    classes = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    linked = components(staged(links(classes), "links"))
    grouped = classes.join(linked, classes.fp == linked.node, "left").select("fp", "first", F.coalesce("label", "fp").alias("family"))
    ids = grouped.groupBy("family").agg(F.min("first").alias("component_id"))
    classed = grouped.select("fp", "family").join(ids, "family").select("fp", "component_id")
    return rows.join(classed, "fp").select("doc_id", "fp", "component_id")

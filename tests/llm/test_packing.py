"""Packing: nothing lost, nothing overlaps, capacities hold, bins are as small as they can be, best fit by hand."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from casebridge.llm import packing, queries
from casebridge.llm.tables import load


def slow_pack(lengths, capacities, cost):
    """Best fit with a scan over all bins, for each going rate; the cheapest."""
    best = None
    for rate in sorted({cost(c) / c for c in capacities}):
        bins = []
        place = []
        for n in lengths:
            fits = [b for b in range(len(bins)) if bins[b][0] - bins[b][1] >= n]
            if fits:
                b = min(fits, key=lambda b: (bins[b][0] - bins[b][1], b))
            else:
                b = len(bins)
                bins.append([min((c for c in capacities if c >= n), key=lambda c: (cost(c) - rate * (c - n), c)), 0])
            bins[b][1] += n
            place.append(b)
        cut = [min(c for c in capacities if c >= used) for _, used in bins]
        total = sum(map(cost, cut))
        if best is None or total < best[0]:
            best = (total, place, cut)
    return best


@pytest.mark.parametrize("seed", range(12))
def test_against_a_slow_version(seed):
    r = random.Random(seed)
    capacities = tuple(sorted(r.sample([4, 8, 16, 32, 64], r.randrange(1, 6))))
    lengths = sorted((r.randrange(1, capacities[-1] + 1) for _ in range(200)), reverse=True)
    cost = r.choice([packing.default_cost, lambda c: c, lambda c: c + c * c / 40, lambda c: c + 10])
    place, sizes = packing.pack(lengths, capacities, cost)
    total, slow_place, slow_sizes = slow_pack(lengths, capacities, cost)
    assert place == slow_place and sizes == slow_sizes
    assert math.isclose(sum(map(cost, sizes)), total)


def test_several_lengths_beat_the_best_single_one():
    r = random.Random(1)
    lengths = sorted((int(r.lognormvariate(6, 1)) % 4000 + 2 for _ in range(3000)), reverse=True)
    joint = sum(map(packing.default_cost, packing.pack(lengths, packing.CAPACITIES, packing.default_cost)[1]))
    alone = sum(map(packing.default_cost, packing.pack(lengths, packing.CAPACITIES[-1:], packing.default_cost)[1]))
    assert joint < alone


def check_packed(rows, sizes, capacities):
    """Pieces cover every document once; slots in a bin do not overlap; every bin has the least capacity that holds it."""
    by_doc, by_bin = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append((r["first_word"], r["n_words"], r["piece"]))
        by_bin.setdefault(r["bin_id"], []).append((r["slot"], r["n_words"] + 1, r["capacity"]))
    assert {k: sum(n for _, n, _ in v) for k, v in by_doc.items()} == {k: n for k, n in sizes.items() if n}
    for pieces in by_doc.values():
        at = 0
        for i, (first, n, piece) in enumerate(sorted(pieces)):
            assert (first, piece) == (at, i)
            at += n
    for entries in by_bin.values():
        at = 0
        for slot, n, _ in sorted(entries):
            assert slot == at
            at += n
        assert {c for _, _, c in entries} == {min(c for c in capacities if c >= at)}


def test_query(spark, medium):
    rows = queries.QUERIES["op1_best_fit_packing"](spark, medium).collect()
    docs = {r["doc_id"]: len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in load(spark, medium, "documents").collect()}
    check_packed(rows, docs, packing.CAPACITIES)
    words, room = sum(r["n_words"] + 1 for r in rows), sum({r["bin_id"]: r["capacity"] for r in rows}.values())
    assert words / room > 0.95


def test_same_bins_however_the_rows_lie(spark, medium, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_PIECES", 100)
    docs = load(spark, medium, "documents")
    a, b = (sorted(map(str, packing.pack_documents(d).collect())) for d in (docs, docs.repartition(13, F.rand(1))))
    assert a == b


def test_shards_are_cut_into_windows(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_LIMIT", 10)
    rows = packing.pack_documents(make_docs([(1, "a b c")] * 35 + [(2, "d e")])).collect()
    assert len(rows) == 36
    assert len({(r["bin_id"], r["slot"]) for r in rows}) == 36


def test_edge_rows(edge_docs, no_docs):
    rows = packing.pack_documents(edge_docs).collect()
    sizes = {}
    for r in rows:
        sizes[r["doc_id"]] = sizes.get(r["doc_id"], 0) + r["n_words"]
    assert sizes == {5: 200_000, 4: 12, 2: 6, 8: 3}
    assert packing.pack_documents(no_docs).collect() == []
    with pytest.raises(ValueError):
        packing.pack_documents(no_docs, capacities=())


@pytest.mark.parametrize("text", [None, "", " ", "\n", "a", " a", "a ", " a\tb\x0b\x0c c\r\n", "a b", "a  b"])
def test_word_count(spark, make_docs, text):
    n = make_docs([(1, text)]).select(packing.word_count(F.col("text"))).first()[0]
    assert n == len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def test_own_lengths(make_docs):
    rows = packing.pack_documents(make_docs([(1, "x"), (2, "y")]), capacities=(4, 8), length=F.col("doc_id") * 7).collect()
    assert sorted((r["doc_id"], r["n_words"]) for r in rows) == [(1, 7), (2, 7), (2, 7)]

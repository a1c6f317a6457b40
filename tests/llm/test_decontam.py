"""Test items in documents against a full edit-distance table."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casebridge.llm import decontam, queries
from casebridge.llm.tables import load


def table_search(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        above, row = row, [i]
        for j, x in enumerate(text, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (c != x)))
    return min(row), row.index(min(row))


@settings(max_examples=300, deadline=None)
@given(st.text("abc", min_size=1, max_size=24), st.text("abc", max_size=40))
def test_bit_parallel_search(item, text):
    assert decontam.search(item, text) == table_search(item, text)


def edited(r, text, n):
    chars = list(text)
    for _ in range(n):
        at = r.randrange(len(chars))
        kind = r.randrange(3)
        chars[at : at + (kind != 0)] = r.choice("xyz") if kind < 2 else ""
    return "".join(chars)


def test_items_within_the_budget_are_found_and_others_not():
    r = random.Random(6)

    def words(n):
        return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randrange(1, 9))) for _ in range(n))

    items = tuple((i, words(30)) for i in range(20))
    finder = decontam.Finder(items)
    for key, item in items:
        k = decontam.edits_allowed(item)
        assert len(decontam.pieces(item)) == k + 1 and "".join(p for _, p in decontam.pieces(item)) == item
        for n in (0, 1, k // 2, k, 3 * k):
            text = f"{words(50)} {edited(r, item, n)} {words(50)}"
            distance, _ = table_search(item, decontam.normalise(text))
            found = {i: d for i, d, _, _ in finder.matches(text)}
            assert found == ({key: distance} if distance <= k else {})


def test_positions_are_those_of_the_source():
    item = "the quick brown fox jumps over the lazy dog again"
    source = "Say:\n  THE quick\n\n brown  FOX jumps over the lazy dog again! ßß the end"
    ((key, distance, a, b),) = decontam.Finder(((5, item),)).matches(source)
    assert (key, distance) == (5, 0)
    assert decontam.normalise(source[a:b]) == item


@pytest.mark.parametrize("text", ["", " a  b ", "ß Straße", "x\ty\nz", "İstanbul ΣΑΣ ǅ"])
def test_normalised_text_with_places(text):
    folded, places = decontam.normalise_with_places(text)
    assert folded == decontam.normalise(text)
    assert len(places) == len(folded) and places == sorted(places)


def test_query_finds_every_verbatim_passage(spark, medium):
    found = {(r["doc_id"], r["item_id"]): r for r in queries.QUERIES["op9_benchmark_decontamination"](spark, medium).collect()}
    docs = {r["doc_id"]: r["text"] for r in load(spark, medium, "documents").collect()}
    items = {r["item_id"]: r["text"] for r in load(spark, medium, "benchmark").collect()}
    folded = {k: decontam.normalise(t) for k, t in docs.items()}
    verbatim = {(d, i) for d, t in folded.items() for i, x in items.items() if decontam.normalise(x) in t}
    assert verbatim and verbatim <= found.keys()
    assert all((r["distance"] == 0) == (key in verbatim) for key, r in found.items())
    for (d, i), r in found.items():
        item = decontam.normalise(items[i])
        assert table_search(item, decontam.normalise(docs[d][r["start"] : r["end"]]))[0] == r["distance"] <= decontam.edits_allowed(item)


def test_several_blocks_and_edge_rows(spark, edge_docs, no_docs, make_docs, monkeypatch):
    schema = "item_id long, text string, start int"
    item = "lorem ipsum dolor sit amet lorem ipsum dolor"
    benchmark = spark.createDataFrame([(1, item, 0), (1, item, 0), (2, None, 0), (3, "", 0), (4, "short", 0), (None, item, 0), (6, item + " sit", 0)], schema)
    one = sorted(tuple(r) for r in decontam.find_items(edge_docs, benchmark).collect())
    assert one == [(5, 1, 0, 0, len(item)), (5, 6, 0, 0, len(item) + 4)]
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 40)
    assert sorted(tuple(r) for r in decontam.find_items(edge_docs, benchmark).collect()) == one
    assert decontam.find_items(no_docs, benchmark).collect() == []
    assert decontam.find_items(edge_docs, benchmark.limit(0)).collect() == []
    twice = make_docs([(1, item), (1, item)])
    assert decontam.find_items(twice, benchmark.where("item_id = 1")).count() == 2


@pytest.mark.parametrize(
    ("item", "source", "expected"),
    [
        ("What is 2+2?", "Q:  what is\n2+2? A: 4", (4, 16)),
        ("2+2=4", "12+2=4, 2+2=45 and 2+2=4.", (19, 24)),
        ("2+2=4", "12+2=4, 2+2=45", None),
        ("cat", "concat cats, a CAT!", (15, 18)),
        ("cat", "concat cats", None),
        ("巴黎是哪国首都", "问巴黎是哪国首都吗", (1, 8)),
        ("a line of 20 letters", "a line of 21 letters", None),
    ],
)
def test_short_items_are_found_verbatim_at_word_bounds(item, source, expected):
    found = decontam.Finder(((1, decontam.normalise(item)),)).matches(source)
    assert found == ([(1, 0, *expected)] if expected else [])


def test_texts_of_one_item_in_several_blocks(spark, make_docs, monkeypatch):
    texts = [f"question {i} of the test, which of its parts is the longest" for i in range(30)]
    benchmark = spark.createDataFrame([(1, t) for t in texts] + [(2, "six by seven"), (2, "what is six by seven")] * 3, "item_id long, text string")
    near = texts[4].replace("longest", "longer")
    docs = make_docs([(1, f"{near} {texts[9]}"), (1, "six by seven"), (2, texts[3]), (2, texts[3]), (3, "six by seventy")])
    one = sorted(tuple(r) for r in decontam.find_items(docs, benchmark).collect())
    assert [r[:3] for r in one] == [(1, 1, 0), (1, 2, 0), (2, 1, 0), (2, 1, 0)]
    collected = []
    broadcast = spark.sparkContext.broadcast
    monkeypatch.setattr(decontam, "BLOCK_CHARS", 400)
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda v: collected.append(sum(len(t) for _, t in v)) or broadcast(v))
    assert sorted(tuple(r) for r in decontam.find_items(docs, benchmark).collect()) == one
    assert len(collected) == 5 and max(collected) < 900

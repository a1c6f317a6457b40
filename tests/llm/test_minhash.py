"""Near duplicates against all pairs of exact sets; hot groups; estimates; components."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from casebridge.llm import graph, minhash, queries
from casebridge.llm.tables import load
from casebridge.llm.words import NOT_SPACE, Words, utf8


def exact_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_force(rows):
    """Smallest linked id and set size of every row, by all pairs."""
    sets = [(i, exact_set(t)) for i, t in rows]
    label = list(range(len(sets)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = sets[i][1], sets[j][1]
        if a and b and min(len(a), len(b)) * 100 >= 85 * max(len(a), len(b)):
            shared = len(a & b)
            if 100 * shared >= 85 * (len(a) + len(b) - shared):
                label[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(sets):
        least[root(i)] = min(key, least.get(root(i), key))
    return sorted((key, len(s), least[root(i)], key == least[root(i)]) for i, (key, s) in enumerate(sets))


def found(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def test_query(spark, medium):
    rows = [(r["doc_id"], r["text"]) for r in load(spark, medium, "documents").collect()]
    assert found(queries.QUERIES["op4_minhash_near_dedup"](spark, medium)) == brute_force(rows)


def test_hot_groups_over_several_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(minhash, "BUCKET_ROWS", 16)
    monkeypatch.setattr(minhash, "FAMILY_ROWS", 8)
    r = random.Random(2)
    base = [f"w{r.randrange(5000)}" for _ in range(120)]
    rows = [(1000 + i, " ".join(base)) for i in range(60)]
    for i in range(120):  # some within reach of each other, some not
        words = list(base)
        for _ in range(r.randrange(7)):
            words[r.randrange(len(words))] = f"x{r.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    r.shuffle(rows)
    expected = brute_force(rows)
    assert found(minhash.near_duplicates(make_docs(rows))) == expected
    assert 1 < len({c for _, _, c, _ in expected}) < 120


def test_edge_rows(edge_docs, no_docs):
    result = found(minhash.near_duplicates(edge_docs))
    assert result == [(2, 2, 2, True), (3, 0, 3, True), (4, 2, 2, False), (4, 2, 2, False), (5, 5, 5, True), (7, 0, 7, True), (8, 1, 8, True), (9, 0, 9, True)]
    assert found(minhash.near_duplicates(no_docs)) == []


def test_sets_are_those_of_the_definition():
    texts = ["", " ", "A b", "a B", "one two three four five", "ONE two  three\tfour\x0bfive six", "é É", None, "a b c d e a b c d e"]
    sizes = [len(s) for s in minhash.document_sets(pa.array(texts))]
    assert sizes == [len(exact_set(t)) for t in texts]
    sets = list(minhash.document_sets(pa.array(["A b", "a B", "ab", "é", "É"])))
    assert sets[0].tolist() == sets[1].tolist() != sets[2].tolist()
    assert sets[3].tolist() != sets[4].tolist()


@pytest.mark.parametrize("similarity", [0.3, 0.6, 0.85, 0.95])
def test_estimates_take_chance_off(similarity):
    random_numbers = np.random.default_rng(1)
    errors = []
    for _ in range(40):
        n = 2000
        shared = int(n * 2 * similarity / (1 + similarity))
        pool = random_numbers.integers(0, 1 << 64, 2 * n, dtype=np.uint64)
        a, b = np.sort(pool[:n]), np.sort(np.concatenate([pool[:shared], pool[n : 2 * n - shared]]))
        sig = [minhash.packed(minhash.minima(x)) for x in (a, b)]
        errors.append(minhash.estimates(sig[0], sig[1][None])[0] - similarity)
    assert abs(np.mean(errors)) < 0.02
    assert np.max(np.abs(errors)) < minhash.MARGIN


def test_links_between_counts_like_set_operations():
    r = np.random.default_rng(4)
    sets = [np.unique(r.integers(0, 40, r.integers(1, 40)).astype(np.uint64)) for _ in range(60)] + [np.arange(30, dtype=np.uint64)] * 3
    got = set(zip(*(x.tolist() for x in minhash.links_between(sets)), strict=True))
    expected = set()
    for i, j in itertools.combinations(range(len(sets)), 2):
        a, b = set(sets[i].tolist()), set(sets[j].tolist())
        if 100 * len(a & b) >= 85 * len(a | b):
            expected.add((i, j))
    assert got == expected


def test_components(spark):
    path = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 560)]
    edges = spark.createDataFrame([*path, *star, (7, 7), (3, 2), (2, 3), (-1, 2)], "a long, b long")
    result = {r["node"]: r["label"] for r in graph.components(edges).collect()}
    assert result == {i: 100 for i in range(100, 161)} | {i: 500 for i in range(500, 560)} | {3: -1, 2: -1, -1: -1}
    assert graph.components(edges.limit(0)).collect() == []


def test_word_hashes_do_not_depend_on_the_place():
    data, offsets = utf8(pa.array(["alpha beta", None, "", "beta  alpha beta"]))
    w = Words(data, offsets, NOT_SPACE)
    assert w.of_text.tolist() == [0, 2, 2, 2, 5]
    assert w.hash[0] == w.hash[3] and w.hash[1] == w.hash[2] == w.hash[4] != w.hash[0]
    sliced, cut = utf8(pa.array(["x", "alpha beta"]).slice(1))
    assert Words(sliced, cut, NOT_SPACE).hash.tolist() == w.hash[:2].tolist()

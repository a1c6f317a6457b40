"""Collocations against plain counting of every phrase, and against SQL."""

import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import connect, difference

from casebridge.llm import collocations, queries


def plain(rows, least, kept=2000):
    """Rows (lang, rank, phrase, a, l, r, n, score) of texts (lang, text)."""
    f = defaultdict(Counter)
    for lang, text in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            for k in range(1, 5):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        n = sum(c for p, c in counts.items() if len(p) == 1)
        candidates = {p: c for p, c in counts.items() if len(p) > 1 and c >= least}
        dropped = {
            longer[i : i + k]
            for longer, c in candidates.items()
            for k in range(2, len(longer))
            for i in range(len(longer) - k + 1)
            if 100 * c >= 80 * counts[longer[i : i + k]]
        }
        scored = []
        for p, a in candidates.items():
            if p not in dropped:
                score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, i + 1, p.decode(), -a, left, right, n, -s) for i, (s, a, p, left, right) in enumerate(sorted(scored)[:kept])]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())


def texts(seed, docs=120):
    r = np.random.default_rng(seed)
    vocabulary = np.array(["The", "of", "and", "straße", "你好", "x", "new", "york", "city", "--", "a'b"] + [f"w{i}" for i in range(300)])
    ranks = r.zipf(1.3, size=(docs, 200)) % len(vocabulary)
    blanks = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", " ; "]
    rows = []
    for i in range(docs):
        words = vocabulary[ranks[i]]
        text = "".join(w + blanks[int(b)] for w, b in zip(words, r.integers(0, len(blanks), 200), strict=True))
        rows.append((["en", "de", None][i % 3], text + " New York City" * int(r.integers(0, 5))))
    return rows + [("en", None), (None, ""), ("fr", " \t.!"), ("en", "one"), ("zz", "only once here")]


@pytest.fixture
def tables(spark):
    def make(rows):
        full = [(i, lang, text, 1, "p") for i, (lang, text) in enumerate(rows)]
        return spark.createDataFrame(full, "doc_id long, lang string, text string, a int, phrase string").repartition(5)

    return make


@pytest.mark.parametrize("least", [3, 30])
def test_against_plain_counting(spark, tables, least):
    rows = texts(1)
    assert found(collocations.collocations(tables(rows), least)) == plain(rows, least)


def test_summaries_that_overflow_lose_nothing(tables, monkeypatch):
    monkeypatch.setattr(collocations, "CAPACITY", 1)
    monkeypatch.setattr(collocations, "TASK_PHRASES", 500)
    monkeypatch.setattr(collocations, "BITS_LEAST", 64)
    monkeypatch.setattr(collocations, "BITS_MOST", 1024)  # nearly all bits are set: results may not depend on them
    rows = texts(2)
    assert found(collocations.collocations(tables(rows), 10, kept=7)) == plain(rows, 10, 7)


def test_edge_rows(edge_docs, no_docs):
    rows = [(r["lang"], r["text"]) for r in edge_docs.collect()]
    assert found(collocations.collocations(edge_docs, 2)) == plain(rows, 2)
    assert found(collocations.collocations(no_docs)) == []


@pytest.mark.parametrize("capacity", [1, 3, 20, 400])
def test_summary_keeps_its_promise(capacity):
    """Merged in any order: counts are low by ``taken`` at most, which stays under mass / capacity."""
    r = np.random.default_rng(capacity)
    stream = (r.zipf(1.4, 20_000) % 3000).astype(np.uint64)
    true = Counter(stream.tolist())
    merged = collocations.Summary(capacity)
    for part in np.array_split(stream, 13):
        own = collocations.Summary(capacity)
        for piece in np.array_split(part, 7):
            own.merge(*collocations.added(piece, np.ones(len(piece), np.int64)))
        merged.merge(own.keys, own.counts, own.taken)
    assert len(merged.keys) <= capacity
    assert merged.taken * (capacity + 1) <= len(stream)
    kept = dict(zip(merged.keys.tolist(), merged.counts.tolist(), strict=True))
    assert all(c - merged.taken <= kept.get(k, 0) <= c for k, c in true.items())
    least = len(stream) // (capacity + 1) + 1
    assert {k for k, c in true.items() if c >= least} <= set(merged.at_least(least).tolist())


def test_a_summary_with_a_least_count_loses_no_frequent_key():
    """Whatever comes first: rare keys that fill it, or few keys often."""
    r = np.random.default_rng(8)
    stream = np.concatenate([np.arange(5000), r.permutation(np.repeat(np.arange(40), 9)), np.arange(9000, 12_000), np.repeat(7, 100)]).astype(np.uint64)
    true = Counter(stream.tolist())
    for order in (stream, stream[::-1], r.permutation(stream)):
        for least in (2, 5, 10):
            merged = collocations.Summary(3, least)
            for piece in np.array_split(order, 60):
                merged.merge(*collocations.added(piece, np.ones(len(piece), np.int64)))
            assert merged.taken < least
            assert {k for k, c in true.items() if c >= least} <= set(merged.at_least(least).tolist())


def test_packed_keys_come_back():
    r = np.random.default_rng(4)
    keys = np.unique(r.integers(0, 1 << 32, 5000, dtype=np.uint64))
    counts = r.integers(1, 1 << 31, len(keys))
    back = collocations._unpack(*collocations._pack(keys, counts), len(keys))
    assert np.array_equal(back[0], keys) and np.array_equal(back[1], counts)


def test_large_counts_are_exact(spark):
    """2,000,000 times a count passes 64 bits."""
    big = 9_000_000_000_000_000_000
    rows = [("en", "a b", 2, big - 7), ("en", "a", 1, big - 1), ("en", "b", 1, big), ("en", "a b c", 3, big - 8), ("en", "b c", 2, big - 3), ("en", "c", 1, big)]
    frequent = spark.createDataFrame(rows, "lang string, phrase string, words int, a long")
    scores = {r["phrase"]: (r["score"], r["l"], r["r"]) for r in collocations.scored(frequent).collect()}
    assert scores["a b"] == (2_000_000 * (big - 7) // (2 * big - 1), big - 1, big)
    assert scores["a b c"] == (2_000_000 * (big - 8) // (big - 7 + big), big - 7, big) or scores["a b c"][0] == 999_999


def test_query_against_sql(spark, small):  # sf0.01 with the other queries in test_licenses
    df = queries.op11_collocations(spark, small)
    assert [k for _, k in df.dtypes] == ["string", "bigint", "string", *["bigint"] * 5]
    assert difference(df, connect(small), queries.ORACLE["op11_collocations"]) == ""

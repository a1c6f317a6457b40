"""License scan against plain sets and places, and against its SQL."""

import random
import re
import sys

import duckdb
import pytest

from casebridge.llm import licenses, queries
from casebridge.llm.tables import load

WORDS = re.compile(licenses.WORD)


def plain(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORDS.findall(text)
    places, base, notices = [], set(), {}
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += at
        base |= {label} if at else set()
    for _, name, wanted, need in licenses.templates(licenses.NOTICES, {}):
        run = -(-3 * len(WORDS.findall(licenses.NOTICES[name])) // 2)
        shared = max((len(set(words[i : i + run]) & set(wanted)) for i in range(len(words))), default=0)
        if shared >= need:
            notices[name] = shared / len(wanted)
    return len(words), sorted(places), sorted(base), sorted(notices.items())


def found(df):
    return sorted((r["doc_id"], r["n_words"], sorted(r["places"]), sorted(r["base"]), [tuple(n) for n in r["notices"]]) for r in licenses.scan_licenses(df).collect())


def test_query_columns_against_sql_on_every_scale(spark, small, medium):
    for sf_dir in (small, medium):
        with duckdb.connect() as con:
            con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
            con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
            for name in queries.ORACLE:
                df = queries.QUERIES[name](spark, sf_dir)
                cols = sorted(df.columns)
                theirs = con.execute(f"SELECT {', '.join(cols)} FROM ({queries.ORACLE[name]})").fetchall()
                assert sorted(map(repr, (tuple(r) for r in df.select(cols).collect()))) == sorted(map(repr, theirs))


def test_made_up_texts(make_docs):
    r = random.Random(8)
    vocabulary = sorted({w for _, _, words, _ in licenses.templates(licenses.NOTICES, licenses.PHRASES) for w in words})
    texts = list(licenses.NOTICES.values()) + [p.upper() for p in licenses.PHRASES] + ["CC-BY cc  by, cc\nby ccby", "all rights\nreserved", "cc cc by by"]
    for notice in licenses.NOTICES.values():
        for _ in range(6):
            words = notice.split()
            for _ in range(r.randrange(4)):
                words[r.randrange(len(words))] = r.choice(["x", "Y", *vocabulary])
            r.shuffle(words)
            texts.append(r.choice([" ", ", ", " \t"]).join(words) + r.choice(["", "\n", "\nmore text here"]))
    texts += [" ".join(r.choices(vocabulary, k=r.randrange(1, 60))) for _ in range(60)]
    rows = list(enumerate(texts))
    assert found(make_docs(rows)) == [(i, *plain(t)) for i, t in rows]


WRAPPED = {
    "mit-text": "# Permission is hereby granted, free of charge, to any person obtaining a copy\n# of this software and associated documentation files (the \"Software\"), to deal\n# in the Software without restriction",
    "bsd": " * Redistribution and use in source and binary forms, with or without\n * modification, are permitted provided that the following conditions\n * are met:",
    "apache-2.0": "Licensed under the Apache License,\nVersion 2.0 (the \"License\")",
    "lgpl": "This library is free software; you can redistribute it and/or\r\nmodify it under the terms of the GNU Lesser General Public\r\nLicense",
}


@pytest.mark.parametrize("label", WRAPPED)
@pytest.mark.parametrize("before", [0, 30, 95])
def test_notices_wrapped_over_lines(make_docs, label, before):
    text = "word\n" * before + WRAPPED[label] + "\nmore" * before
    assert label in dict(found(make_docs([(1, text)]))[0][4])
    assert found(make_docs([(1, text)])) == [(1, *plain(text))]


def test_words_far_apart_are_no_notice(make_docs):
    text = (" filler" * 20 + " ").join(licenses.NOTICES["bsd"].split())
    assert found(make_docs([(1, text)])) == [(1, *plain(text))] == [(1, 20 * 20 + 21, [], [], [])]


def test_only_ascii_is_folded(make_docs):
    text = "ALL RIGHTS RESERVED, C\u212aC BY \u0130x"
    assert found(make_docs([(1, text), (2, "Cc BY")])) == [(1, *plain(text)), (2, *plain("Cc BY"))]


def test_edge_rows(edge_docs, no_docs, make_docs):
    result = found(edge_docs)
    assert [(r[0], r[1]) for r in result] == [(2, 6), (3, 0), (4, 6), (4, 6), (5, 200_000), (7, 0), (8, 3), (9, 0)]
    assert all(r[2:] == ([], [], []) for r in result)
    assert found(no_docs) == []
    repeated = make_docs([(1, "all rights reserved"), (1, "all rights reserved"), (1, "cc by"), (1, None)])
    assert found(repeated) == sorted([(1, *plain("all rights reserved"))] * 2 + [(1, *plain("cc by")), (1, *plain(None))])


def test_no_python_on_the_path(spark, small, capsys):
    queries.QUERIES["op10_license_scan"](spark, small).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


@pytest.mark.parametrize("name", [n for n, m in list(sys.modules.items()) if n == "casebridge.llm.licenses"])
def test_needs(name):
    assert [t[3] for t in licenses.templates({"a": "one two three four five"}, {"x y": "l"})] == [4, 2]

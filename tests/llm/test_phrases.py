import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from equiscope.llm import phrases
from equiscope.llm.phrases import collocations, frequent_phrases

FOLD = {c: c + 32 for c in range(65, 91)}


def brute_counts(rows):
    f = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (text or "").translate(FOLD)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for size in (1, 2, 3):
                f["und" if lang is None else lang].update(tuple(ws[i : i + size]) for i in range(len(ws) - size + 1))
    return f


def brute(rows, top=2000):
    out = set()
    for lang, f in brute_counts(rows).items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        found = []
        for p, a in f.items():
            if len(p) < 2 or a < 10:
                continue
            if len(p) == 2 and any(len(q) == 3 and b >= 10 and 100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in f.items()):
                continue
            score, _, left, right = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n, -s))
    return out


def check(docs_of, rows, top=2000):
    docs = docs_of([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    got = [tuple(r) for r in collocations(docs, top=top).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows, top)
    return got


def invented(seed, n=60):
    r = random.Random(seed)
    known = ["the", "of", "The", "a", "ÿé", "中文", "x'y", "don-t", "z", "q\x00r", "cat", "sat"]
    weights = [1 / (k + 1) for k in range(len(known))]
    ends = [" ", " ", " ", " ", "  ", "\t", ". ", ",", "\n", " ; ", "!?", "\r", "\x0b"]
    return [("".join(w + r.choice(ends) for w in r.choices(known, weights, k=r.randrange(60))), r.choice(["en", "en", "de", None])) for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_plain_version(docs_of, seed):
    assert len(check(docs_of, invented(seed, 200))) > 20


@pytest.mark.parametrize("budget, block", [(1, 1 << 20), (30, 7), (200, 1), (5, 100)])
def test_groups_and_blocks_of_any_size(docs_of, monkeypatch, budget, block):
    """Prefixes of one, two and three words make groups; texts are longer than a block."""
    monkeypatch.setattr(phrases, "GROUP_SUFFIXES", budget)
    monkeypatch.setattr(phrases, "BLOCK_WORDS", block)
    check(docs_of, invented(5))


def test_vertical_partitioning():
    r = np.random.default_rng(3)
    cells, n = np.arange(2 * phrases.CELLS), r.integers(0, 9, 2 * phrases.CELLS)
    n[[5, 700]], n[phrases.CELLS + np.array([9, 11])] = 5000, [900, 70]
    groups = phrases.Groups(cells, n, 100)
    assert groups.one[5] == groups.one[700] == -1 and groups.two[9] == -1 and groups.many[9] == 9
    load = np.bincount(groups.one[groups.one >= 0], n[: phrases.CELLS][groups.one >= 0])
    assert load.max() < 200
    kinds = [groups.whole_from(g) for g in (0, groups.starts[1], groups.starts[2], groups.starts[2] + 8)]
    assert kinds == [1, 2, 3, 3]
    h = r.integers(0, 1 << 63, (3, 100_000), dtype=np.int64).astype(np.uint64)
    h[0, :50_000] = np.uint64(5 << 40)
    h[1, :40_000] = np.uint64(9 << 40)
    got = groups.of(*h)
    assert got.min() >= 0 and set(got[:40_000].tolist()) == set(range(groups.third[9], groups.third[9] + 9))


def test_large_products_are_exact(spark):
    """The products pass 64 bits."""
    rows = [(10**12 + 7, 10**12 + 9, 10**12 + 13), (999_999_999_989, 10**13, 10**12)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    times = F.lit(phrases.SCORE).cast("decimal(7,0)") * phrases._exact("a") * phrases._exact("a")
    got = df.withColumn("times", times).withColumn("by", phrases._exact("l") * phrases._exact("r")).selectExpr("times div by as s").collect()
    assert [r.s for r in got] == [10**6 * a * a // (left * right) for a, left, right in rows]


def test_longer_phrases_absorb(docs_of):
    rows = [("new york city. " * 10 + "new york. " * 10, "en"), ("ab cd ef. " * 10 + "ab cd. " * 11, "en"), ("la la la la " * 9, "fr")]
    got = {(r[0], r[2]) for r in check(docs_of, rows)}
    assert ("en", "new york") not in got and ("en", "ab cd") in got and ("en", "new york city") in got


def test_first_of_each_language_with_ties(docs_of):
    rows = [(" ".join(f"{w}{k} y{w}{k}." for k in range(9)) * 10, lang) for w in ("p", "q", "É", "z") for lang in ("en", "de")]
    got = check(docs_of, rows, top=7)
    assert len(got) == 14 and {r[-1] for r in got} == {10**6}


def test_odd_rows_and_columns(spark, docs_of):
    rows = [(None, "en"), ("", None), (" \n\t.", "en"), ("a b " * 50_000, None), ("a b\x00c \x1c d " * 20, ""), ("x" * 300_000, "en"),
            ("one two. " * 12, "a\nb\tc"), ("one two. " * 12, "a\nb\tc"), ("A B c! " * 15, "EN")]
    check(docs_of, rows)
    docs = docs_of([(i, t, lang) for i, (t, lang) in enumerate(rows)])
    clashing = docs.withColumns({c: F.lit(c) for c in ("words", "a", "n", "part", "cell", "phrase", "score")})
    assert {tuple(r) for r in collocations(clashing).collect()} == brute(rows)
    assert collocations(docs_of([])).collect() == []
    assert collocations(docs_of([(1, None)])).collect() == []


def test_given_documents(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang").collect()
    rows = [tuple(r) for r in docs]
    got = {(r.lang, " ".join(x for x in (r.a, r.b, r.c) if x)): r.n for r in frequent_phrases(docs_of([(0, *r) for r in rows]), min_count=3).collect() if r.words}
    assert got == {(lang, " ".join(p)): n for lang, f in brute_counts(rows).items() for p, n in f.items() if n >= 3}

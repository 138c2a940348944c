import hashlib
import random
import re

from pyspark.sql import functions as F

from equiscope.llm import substrings
from equiscope.llm.substrings import parse, without_duplicates

SPACES = r"[\x20\x09-\x0d]+"


def words_of(text):
    return [w for w in re.split(SPACES, text or "") if w]


def brute(rows, n=13):
    """{id: (words, removed, words kept)}; a null id is larger than any."""
    key = lambda d: (d is None, d or 0)
    first = {}
    for d, t in sorted(rows, key=lambda r: key(r[0])):
        w = words_of(t)
        for i in range(len(w) - n + 1):
            first.setdefault(tuple(w[i : i + n]), d)
    out = []
    for d, t in rows:
        w = words_of(t)
        covered = set()
        for i in range(len(w) - n + 1):
            if key(first[tuple(w[i : i + n])]) < key(d):
                covered.update(range(i, i + n))
        out.append((d, len(w), len(covered), [x for i, x in enumerate(w) if i not in covered]))
    return out


def check(docs, rows):
    got = [(r.row.doc_id, r.n_words, r.n_removed, words_of(r.text)) for r in parse(docs, keep=["doc_id"]).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(got, key=order) == sorted(brute(rows), key=order)


def passage(r, n, vocabulary=40):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def test_shared_passages_against_brute_force(docs_of):
    r = random.Random(1)
    shared = [passage(r, n) for n in (12, 13, 14, 40, 200)]
    rows = []
    for i in range(120):
        parts = [passage(r, r.randrange(0, 30)) for _ in range(r.randrange(1, 4))]
        for _ in range(r.randrange(0, 3)):
            parts.insert(r.randrange(len(parts) + 1), r.choice(shared))
        rows.append((i * 3 % 120, r.choice([" ", "\n", "\t "]).join(parts)))
    check(docs_of(rows), rows)


def test_small_vocabulary(docs_of):
    """Many chance repeats of seeds, some of windows."""
    r = random.Random(2)
    rows = [(i, passage(r, 60, 2)) for i in range(60)]
    check(docs_of(rows), rows)


def test_odd_rows(docs_of):
    long_text = " ".join(f"x{i}" for i in range(20000))
    rows = [(1, None), (2, ""), (3, " \n"), (4, "a " * 12), (5, "a " * 13), (6, "a " * 30), (7, long_text), (8, long_text),
            (9, long_text), (9, long_text), (None, "a " * 13), (None, "b " * 13), (None, "b " * 13), (-4, "a\xa0b " * 13)]
    check(docs_of(rows), rows)


def test_blocks_and_buckets_do_not_matter(spark, docs_of, monkeypatch):
    r = random.Random(5)
    base = passage(r, 100, 500)
    rows = [(i, base + " " + passage(r, 50, 500) if i % 3 else passage(r, 80, 500)) for i in range(60)]
    for size in (300, 5000, 1 << 30):
        monkeypatch.setattr(substrings, "LEAST_BYTES", size)
        check(docs_of(rows), rows)


def test_factors_name_their_source(docs_of):
    r = random.Random(6)
    a, b = passage(r, 30, 9999), passage(r, 30, 9999)
    rows = [(1, a), (2, b), (3, f"new start {a} {b} new end")]
    got = {x.row.doc_id: x for x in parse(docs_of(rows), keep=["doc_id"]).collect()}
    assert [tuple(f) for f in got[3].factors] == [(2, 30, 1), (32, 30, 2)]
    assert got[3].text == "new start new end" and got[1].factors == []


def test_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:] for r in substrings.op7_substrings(spark, sf).collect()}
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert got == {d: (n, k, hashlib.sha256(" ".join(w).encode()).hexdigest()) for d, n, k, w in expected}
    assert any(v[1] for v in got.values())


def test_columns_pass_through(docs_of):
    docs = docs_of([(1, "k " * 20), (2, "k " * 20 + "end")])
    clashing = docs.withColumns({"block": F.lit("x"), "row": F.lit(1), "id": F.lit(2), "bucket": F.lit(3), "bits": F.lit(4)})
    out = without_duplicates(clashing)
    assert out.columns == clashing.columns
    assert {r.doc_id: (r.text, r.n_chars) for r in out.collect()} == {1: ("k " * 20, 40), 2: ("end", 3)}
    assert without_duplicates(docs_of([])).count() == 0

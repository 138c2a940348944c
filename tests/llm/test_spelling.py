import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from equiscope.llm import spelling
from equiscope.llm.spelling import Runs, variants

FOLD = {c: c + 32 for c in range(65, 91)}


def brute_words(rows):
    total = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows):
    words = brute_words(rows)
    near, form = defaultdict(list), {}
    listed = sorted(words)
    for i, a in enumerate(listed):
        for b in listed[i + 1 :]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o))
        if words[best] >= 2 * words[w]:
            form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words.get(form.get(w))))
    return out


def check(docs_of, rows):
    got = [tuple(r) for r in variants(docs_of(rows)).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)
    return got


def invented(seed, n, letters="abéÿ", size=(4, 9)):
    r = random.Random(seed)
    known = ["".join(r.choices(letters, k=r.randrange(*size))) for _ in range(n)]
    weights = [1 / (k + 1) for k in range(n)]
    return [(i, " ".join(r.choices(known, weights, k=200))) for i in range(30)]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(docs_of, seed):
    got = check(docs_of, invented(seed, 500))
    assert any(r[1] for r in got)


def test_large_groups_are_cut_into_blocks(docs_of, monkeypatch):
    rows = [(i, t + " " + " ".join("zzzzz" + w for w in t.split())) for i, t in invented(3, 400)]
    for words, chars in ((4, 1 << 15), (512, 20), (7, 40)):
        monkeypatch.setattr(spelling, "TILE_WORDS", words)
        monkeypatch.setattr(spelling, "TILE_CHARS", chars)
        check(docs_of, rows)


def test_blocks_split_hot_groups(spark, docs_of, monkeypatch):
    monkeypatch.setattr(spelling, "TILE_WORDS", 8)
    counted = spark.createDataFrame([("q" * 6 + a + b + c + d, 3) for a in "abcd" for b in "abcd" for c in "abcd" for d in "abcd"], "word string, n long")
    sizes = spelling.tiles(counted).groupBy("m", "side", "affix", "a", "b").count()
    assert max(r["count"] for r in sizes.collect()) <= 4 * 8
    near = spelling.near_words(counted).collect()
    assert len(near) == 256 and {r.n_near for r in near} == {12}


def test_ties_and_chains(docs_of):
    # abcde <- abcdf (2x) <- abcgf (2x) <- abhgf; equal counts: the smallest near word
    text = "abcde " * 3 + "abcdf " * 6 + "abcgf " * 12 + "abhgf " * 24 + "mmmmm " * 3 + "mmmmz " * 9 + "mmmma " * 9 + "MMMMA"
    got = {r[0]: r for r in check(docs_of, [(7, text)])}
    assert got["abcde"][2] == "abhgf" and got["mmmmm"][1] == "mmmma"


def test_odd_rows_and_columns(spark, docs_of):
    rows = [(1, None), (2, ""), (None, "words words words wordz"), (3, " \n"), (4, "wörds wörds wörds Wordz WORDZ ÀÉÎÕÜ àéîõü"),
            (4, "wörds×wörds÷"), (4, "wörds×wörds÷"), (5, "中文words語 Āwords ŵords ábcdef"), (6, "a" * 70_000),
            (7, "a" * 70_000), (8, "a" * 69_999 + "b"), (8, "a" * 69_999 + "b"), (9, "a" * 69_999 + "b " + "a" * 70_000)]
    check(docs_of, rows)
    clashing = docs_of(rows).withColumns({c: F.lit(c) for c in ("word", "n", "form", "m", "side", "best")})
    assert {tuple(r) for r in variants(clashing).collect()} == brute(rows)
    assert variants(docs_of([])).collect() == []
    assert variants(docs_of([(1, "abc abc")])).collect() == []


def test_given_documents(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    check(docs_of, [tuple(r) for r in docs][:60])


def test_crc_of_runs():
    texts = ["one Two ÿÿ 1x" + "y" * 50, "", "éa"]
    x = Runs([t.encode() for t in texts])
    states = np.array([zlib.crc32(f"{i}:".encode()) ^ 0xFFFFFFFF for i in (5, -1, 77)], np.uint32)
    runs = [(i, r) for i, t in zip((5, -1, 77), texts) for r in re.findall("[A-Za-zÀ-ÿ]+", t.translate(FOLD))]
    assert x.crc(states).tolist() == [zlib.crc32(f"{i}:{r}".encode()) for i, r in runs]


def test_tiles_that_span_batches():
    """A tile's rows may arrive in several Arrow batches."""
    words = sorted("".join(random.Random(k).choices("ab", k=6)) for k in range(60))
    words = sorted(set(words))
    rows = pa.table({"m": [6] * len(words), "side": [0] * len(words), "affix": [1] * len(words), "a": [0] * len(words),
                     "b": [0] * len(words), "block": [0] * len(words), "word": words, "n": [3] * len(words)})
    same = [w[:3] for w in words]
    parts = [b for p in sorted(set(same)) for b in rows.filter(pa.array([s == p for s in same])).set_column(
        2, "affix", pa.array([hash(p)] * same.count(p))).to_batches(max_chunksize=3)]
    got = {w: n for b in spelling._compare(parts) for w, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    expected = Counter(a for a in words for b in words if a[:3] == b[:3] and one_edit(a, b))
    assert got == dict(expected)

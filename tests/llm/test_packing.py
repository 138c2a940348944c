import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from equiscope.llm.packing import Tokens, fullest, minimum_slack, op10_packing, pack, places


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


ALPHABET = list("ab1 \n\t.,'é ß　  \x1c中🎉") + ["'s", "<|endoftext|>", "  ", " a", " é", "don't"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=12).map("".join), min_size=1, max_size=5))
def test_ids_equal_the_library(texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")) if not hasattr(Tokens, "_lib") else Tokens._lib
    Tokens._lib = library
    got = Tokens.get("byte_bpe_50k").encode([t.encode() for t in texts])
    assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_fullest_against_all_subsets():
    r = random.Random(1)
    for _ in range(200):
        counts = Counter(r.choices(range(1, 30), k=r.randrange(1, 9)))
        room = r.randrange(0, 60)
        items = list(counts.elements())
        best = max(s for m in range(1 << len(items)) if (s := sum(x for i, x in enumerate(items) if m >> i & 1)) <= room)
        got = fullest(dict(counts), room)
        assert sum(got) == best and not Counter(got) - counts


def test_plan_uses_every_piece_once():
    r = random.Random(2)
    for _ in range(30):
        counts = Counter(r.choices(range(1, 101), k=r.randrange(1, 400)))
        plan = minimum_slack(dict(counts), 100)
        used = Counter()
        for times, chosen in plan:
            assert sum(chosen) <= 100 and times > 0
            for n in chosen:
                used[n] += times
        assert used == counts
        taken = Counter()
        for n, low, high, per_bin, _, _ in places(plan):
            assert low == taken[n] and (high - low) % per_bin == 0
            taken[n] = high
        assert taken == counts


def check(rows, docs, library, capacity=1024):
    out = pack(docs, capacity=capacity).collect()
    expected = Counter()
    for d, t in rows:
        ids = np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        start, first = 0, len(ids) % capacity or min(len(ids), capacity)
        for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
            expected[(d, piece, start, end - start, zlib.crc32(ids[start:end].tobytes()))] += 1
            start = end
        assert start == len(ids)
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out) == expected
    by_bin = {}
    for r in out:
        by_bin.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places_ in by_bin.values():
        at = 0
        for offset, length in sorted(places_):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_bin), sum(r.length for r in out)


def test_odd_rows(docs_of, library):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (4, "word " * 1023), (5, "word " * 1024), (6, "word " * 5000),
            (None, "x"), (7, "<|endoftext|>"), (8, "  lead\n\n trail  ")]
    check(rows, docs_of(rows), library)
    check(rows, docs_of(rows), library, capacity=7)
    assert pack(docs_of([])).count() == 0


def test_table_is_near_the_bound(spark, sf, library):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    bins, total = check([(r.doc_id, r.text) for r in docs.collect()], docs, library)
    assert bins <= 1.02 * total / 1024 + 2


def test_clashing_columns(spark, docs_of):
    from pyspark.sql import functions as F

    docs = docs_of([(1, "a")]).withColumns({"task": F.lit(1), "length": F.lit(2), "number": F.lit(3)})
    assert pack(docs).count() == 1


def test_query_columns(spark, sf):
    assert op10_packing(spark, sf).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

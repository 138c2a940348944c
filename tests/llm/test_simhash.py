import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from equiscope.llm import components, simhash
from equiscope.llm.simhash import close_pairs, keep_first, near_duplicates, near_groups
from equiscope.llm.xxh64 import xxh64_spans


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, distance):
    """Brute force: {id: smallest id reachable}."""
    parent = {i: i for i in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if j < i and (prints[i] ^ prints[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_hash_equals_library():
    r = np.random.default_rng(3)
    buf = r.integers(0, 256, 4000).astype(np.uint8)
    at, n = r.integers(0, 3000, 2000), r.integers(0, 400, 2000)
    raw = buf.tobytes()
    assert [int(h) for h in xxh64_spans(buf, at, n)] == [
        xxhash.xxh64_intdigest(raw[a : a + k], 42) for a, k in zip(at, n)
    ]


ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "One  TWO"), (6, "one two"), (7, "É é ß İ"), (7, "É é ß İ"),
    (8, "a b c d e f g"), (9, "A B\tC d\ne F g"), (10, "x" * 5000), (11, " ".join(f"w{i}" for i in range(30000))),
    (12, "a\x00b c d"), (13, "a\xa0b c d"),
]


def test_fingerprints_and_groups_of_odd_texts(docs_of):
    got = {r.doc_id: r for r in near_duplicates(docs_of(ODD)).collect()}
    expected = {i: fingerprint(t) for i, t in ODD}
    assert {i: r.fingerprint for i, r in got.items()} == {i: signed(f) for i, f in expected.items()}
    assert {i: r.component_id for i, r in got.items()} == groups(expected, 2)
    assert near_duplicates(docs_of(ODD)).count() == len(ODD)  # repeated rows stay


def test_table_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r.component_id for r in near_duplicates(docs).collect()}
    assert got == groups({r.doc_id: fingerprint(r.text) for r in docs.collect()}, 2)


def near_copies(distance, n, seed):
    """Prints around a few centres, with chains of close neighbours."""
    r = random.Random(seed)
    out = []
    for _ in range(4):
        x = r.getrandbits(64)
        for _ in range(n):
            for b in r.sample(range(64), r.randint(0, distance)):
                x ^= 1 << b
            out.append(x)
    return {i: x for i, x in enumerate(dict.fromkeys(out))}


def test_hot_buckets_link_what_all_pairs_link(spark, monkeypatch):
    for distance in (1, 2, 3):
        prints = near_copies(distance, 60, distance)
        df = spark.createDataFrame([(i, signed(x)) for i, x in prints.items()], "doc_id long, fingerprint long")
        expected = groups(prints, distance)
        for limit in (1, 16, 10_000):
            monkeypatch.setattr(simhash, "BUCKET_LIMIT", limit)
            of = {r.fingerprint: r.component_id for r in near_groups(df, distance).collect()}
            assert {i: of[signed(x)] for i, x in prints.items()} == expected, (distance, limit)


def test_every_pair_is_close(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BUCKET_LIMIT", 1)
    prints = near_copies(2, 40, 9)
    df = spark.createDataFrame([(signed(x),) for x in prints.values()], "fp long")
    rows = close_pairs(df).collect()
    assert rows and all(((r.a ^ r.b) & (2**64 - 1)).bit_count() <= 2 for r in rows)


def test_empty_and_extra_columns(spark, docs_of):
    from pyspark.sql import functions as F

    assert near_duplicates(docs_of([])).count() == 0
    docs = docs_of([(1, "a b c"), (2, "a b c"), (3, "something else entirely here")])
    clashing = docs.withColumns({"fingerprint": F.lit("x"), "row": F.lit(1), "component_id": F.lit(2), "fp": F.lit(3)})
    kept = keep_first(clashing)
    assert kept.columns == clashing.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3}


def test_keep_first_keeps_one_row_of_an_id(docs_of):
    rows = [(5, "same text of a row"), (5, "same text of a row"), (6, "same text of a row"), (None, "same text of a row")]
    assert [r.doc_id for r in keep_first(docs_of(rows)).collect()] == [5, None]


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901), (7, 7), (None, 3)], "a long, b long")
    got = {r.id: r.component for r in components.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 901: 900}


def test_keep_first_with_clashing_names_and_repeated_ids(spark, docs_of):
    words = [" ".join(f"w{i}x{j}" for j in range(40)) for i in range(4)]
    rows = [(1, words[0]), (2, words[0]), (3, words[1]), (3, words[2]), (3, words[2]), (None, words[3]), (None, words[3])]
    names = ("__first", "id", "row", "by", "h", "component_id", "fingerprint")
    docs = docs_of(rows).withColumns({c: F.lit(c) for c in names})
    got = [simhash.keep_first(d) for d in (docs, docs.repartition(5))]
    assert all(g.columns == docs.columns for g in got)
    kept = [sorted((r.doc_id or 0, r.text) for r in g.collect()) for g in got]
    assert kept[0] == kept[1] and [i for i, _ in kept[0]].count(0) == 2
    assert [t for i, t in kept[0] if i == 1] == [words[0]] and sum(i == 2 for i, _ in kept[0]) == 0

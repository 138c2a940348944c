import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from equiscope.llm import bitslice
from equiscope.llm.bitslice import Slices, op2_bitsliced_topk, quantise, search_block, top_k


def test_score_slices_are_the_inner_products():
    r = np.random.default_rng(1)
    for n, dims, size in ((1, 3, 5), (64, 4, 100), (200, 7, 3000), (65, 1, 1)):
        rows = r.integers(-size, size + 1, (n, dims))
        index = Slices(rows)
        for q in (r.integers(-size, size + 1, dims), np.zeros(dims, np.int64), np.full(dims, -size)):
            slices, constant = index.score(q)
            bits = np.unpackbits(slices.view(np.uint8), axis=1, bitorder="little")[:, :n].astype(np.int64)
            got = (bits << np.arange(len(slices))[:, None]).sum(axis=0) + constant
            assert got.tolist() == (rows @ q).tolist()


def test_top_rows_with_ties():
    r = np.random.default_rng(2)
    for _ in range(60):
        n, k = int(r.integers(1, 150)), int(r.integers(1, 12))
        rows, q = r.integers(-2, 3, (n, 2)), r.integers(-2, 3, 2)
        ids = np.sort(r.choice(1000, n, replace=False))
        own = int(r.choice(ids))
        got_ids, got = search_block(Slices(rows), ids, q, own, k)
        score = dict(zip(ids.tolist(), (rows @ q).tolist()))
        del score[own]
        best = sorted(score.items(), key=lambda x: (-x[1], x[0]))[:k]
        assert sorted(zip(got_ids.tolist(), got.tolist())) == sorted(best)


@pytest.fixture
def vectors(spark):
    rows = [(0, [0.5, 0.25]), (1, [0.5, 0.25]), (2, [-0.5, 1.0]), (2, [-0.5, 1.0]), (3, None), (4, []), (5, [float("nan"), 1.0]),
            (6, [float("inf"), 1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [1.0]), (9, [0.1, 0.2, 0.3]), (10, [-0.0, 0.0]), (11, [1e30, 0.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute(rows, queries, k):
    out = []
    for q in queries:
        scores = [(c, sum(a * b for a, b in zip(rows[q], rows[c]))) for c in rows if c != q]
        for rank, (c, s) in enumerate(sorted(scores, key=lambda x: (-x[1], x[0]))[:k], 1):
            out.append((q, rank, c, s))
    return out


def clipped(rows):
    return [(*r[:3], min(max(r[3], -(2**63)), 2**63 - 1)) for r in rows]


def test_large_components_are_ranked_exactly(spark, tmp_path):
    """All finite vectors take part, also where the score passes 64 bits."""
    data = [(0, [1.0, 2.0]), (1, [20000.0, 1.0]), (2, [1.0, 1.0]), (3, [-2e18, 3e17]), (4, [2e15, 1e15]), (5, [2e15, 1e15 + 1]),
            (6, [-1e300, 1e300]), (7, []), (100, [3e15, -5e15]), (200, [1e30, -1e30]), (300, [-7.0, 0.5])]
    table = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    q = quantise(table)
    rows = {r.vec_id: list(r.q) for r in q.collect()}
    assert len(rows) == len(data)
    expected = sorted(clipped(brute(rows, rows, 10)))
    assert sorted(map(tuple, top_k(q, q).collect())) == expected
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    sql = sorted((a, b, c, d) for a, b, c, d in con.execute(bitslice.ORACLE_SQL).fetchall())
    assert sql == sorted(map(tuple, op2_bitsliced_topk(spark, str(tmp_path)).collect()))
    assert sql == sorted(clipped(brute(rows, [i for i in rows if i % 100 == 0], 10)))


def test_odd_vectors(spark, vectors):
    q = quantise(vectors.withColumns({"q": F.lit(1), "block": F.lit(2)}))
    rows = {r.vec_id: list(r.q) for r in q.collect()}
    assert sorted(rows) == [0, 1, 2, 4, 8, 9, 10, 11] and q.count() == 8 and rows[11] == [2**63 - 1, 0]
    assert sorted(map(tuple, top_k(q, q, 3).collect())) == sorted(clipped(brute(rows, rows, 3)))
    assert top_k(q.limit(0), q.limit(0)).count() == 0 and top_k(q, q.limit(0)).count() == 0


def test_blocks_do_not_matter(spark, monkeypatch):
    r = np.random.default_rng(5)
    data = [(i, [float(x) for x in np.round(r.normal(size=3), 2)]) for i in range(150)]
    q = quantise(spark.createDataFrame(data, "vec_id long, embedding array<double>"))
    rows = {x.vec_id: list(x.q) for x in q.collect()}
    expected = sorted(brute(rows, [i for i in rows if i % 10 == 0], 10))
    for block, queries in ((7, 2), (60, 100), (1000, 1)):
        monkeypatch.setattr(bitslice, "BLOCK_ROWS", block)
        monkeypatch.setattr(bitslice, "QUERY_ROWS", queries)
        assert sorted(map(tuple, top_k(q, q.filter("vec_id % 10 = 0")).collect())) == expected


def test_query_against_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    expected = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({bitslice.ORACLE_SQL}) ORDER BY 1, 2").fetchall()
    assert [tuple(r) for r in op2_bitsliced_topk(spark, sf).orderBy("query_id", "rank").collect()] == expected

"""Exact top-k by inner product over a bit-sliced index.

Vectors are quantised to integers, ``floor(scale * x)``.  The candidates are
dealt into blocks; a block's index holds, per component and bit, a bitmap with
one bit per row (the component less the block's least value, so that all
numbers are non-negative).  For a query, the score is added up with bitmap
arithmetic: every bit of a query component adds that component's slices,
shifted; bitmaps of one weight are reduced by full adders, three to two, until
one bitmap per weight is left: the slices of the score.  (For a negative
component the slices are complemented.  Both shifts change all scores of a
query and block by one constant, which is added back.)

The top rows are then picked from the most significant slice downward: rows
with the bit set come before the others; when they would be too many, the
search goes on among them.  What remains at the end is a set of rows of equal
score, of which the smallest ids are taken: the result is exact.  Blocks give
k rows per query, and one ranking per query over (k x blocks) rows ends it.

Query blocks meet candidate blocks by an equi-join on the candidate block, one
pair of packed blocks at a time: that is the stated query set against all
rows, in blocks.

Defined results: vectors that are null or hold a null or a non-finite
component, and rows with a null id, take no part.  Quantised components are
64-bit whole numbers (beyond that, the nearest one).  Scores are exact and
ranked as such at any size; one that does not fit a long is given as the
nearest long.  Rows that repeat id and vector count once; a candidate with the
query's own id never counts.  Vectors of different lengths are compared as if
the shorter went on with zeros, an empty one too.  An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from equiscope.llm.rows import cut_lineage, read

K = 10
SCALE = 1024
QUERY_EVERY = 100
#: Rows per candidate block and queries per query block.
BLOCK_ROWS = 16384
QUERY_ROWS = 128
_ALL = (1 << 64) - 1
_LOW = (1 << 63) - 1


def quantise(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id long, q array<long>), different rows."""
    x = F.col(embedding)
    q = F.transform(x, lambda v: F.floor(F.lit(scale).cast("double") * v.cast("double")))
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) == float("inf")))
    taken = vectors.filter(F.col(vec_id).isNotNull() & x.isNotNull() & ~F.coalesce(bad, F.lit(True)))
    return taken.select(F.col(vec_id).cast("long").alias("vec_id"), q.alias("q")).distinct()


class Slices:
    """Bit-sliced index of the rows of a block."""

    def __init__(self, rows: np.ndarray):
        n, self.dims = rows.shape
        self.rows = n
        self.low = int(rows.min()) if rows.size else 0
        shifted = rows.astype(np.uint64) - np.uint64(self.low & _ALL)  # the difference may pass 63 bits
        self.bits = max(int(shifted.max()).bit_length(), 1) if rows.size else 1
        words = -(-n // 64)
        padded = np.zeros((words * 64, self.dims), np.uint64)
        padded[:n] = shifted
        self.maps = np.empty((self.dims, self.bits, words), np.uint64)
        for j in range(self.bits):
            bit = ((padded >> np.uint64(j)) & np.uint64(1)).astype(np.uint8).T
            self.maps[:, j] = np.packbits(np.ascontiguousarray(bit), axis=1, bitorder="little").view("<u8")
        exists = np.zeros(words * 64, np.uint8)
        exists[:n] = 1
        self.exists = np.packbits(exists, bitorder="little").view("<u8")

    def score(self, query: np.ndarray) -> tuple[np.ndarray, int]:
        """Slices of the shifted scores, least significant first, and the
        constant to add to a shifted score."""
        top = (1 << self.bits) - 1
        weights: dict[int, list[np.ndarray]] = {}
        constant = 0
        for sign in (1, -1):
            dims = np.flatnonzero(query > 0 if sign > 0 else query < 0)
            if not len(dims):
                continue
            size = query[dims].astype(np.uint64)
            size = size if sign > 0 else np.uint64(0) - size
            maps = self.maps[dims] if sign > 0 else ~self.maps[dims]
            constant += sum(query[dims].tolist()) * (self.low if sign > 0 else self.low + top)
            for i in range(int(size.max()).bit_length()):
                chosen = maps[(size >> np.uint64(i)) & np.uint64(1) == 1]
                if len(chosen):
                    for j in range(self.bits):
                        weights.setdefault(i + j, []).append(chosen[:, j])
        return self._add(weights), constant

    def _add(self, weights: dict[int, list[np.ndarray]]) -> np.ndarray:
        """One bitmap per weight out of many, by full adders."""
        out, weight = [], 0
        while weights:
            stacks = weights.pop(weight, [])
            at = np.concatenate(stacks) if stacks else np.empty((0, len(self.exists)), np.uint64)
            carries = weights.setdefault(weight + 1, []) if len(at) > 1 else []
            while len(at) > 1:
                if len(at) == 2:
                    carries.append(at[:1] & at[1:])
                    at = at[:1] ^ at[1:]
                    break
                third = len(at) // 3
                a, b, c = at[:third], at[third : 2 * third], at[2 * third : 3 * third]
                half = a ^ b
                carries.append((a & b) | (half & c))
                at = np.concatenate([half ^ c, at[3 * third :]])
            out.append(at[0] if len(at) else np.zeros(len(self.exists), np.uint64))
            weight += 1
        return np.array(out) if out else np.zeros((1, len(self.exists)), np.uint64)

    def top(self, slices: np.ndarray, k: int, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bitmaps of the rows above the boundary, and of those on it."""
        sure, open_ = np.zeros_like(alive), alive.copy()
        have = 0
        for s in slices[::-1]:
            ones = open_ & s
            n = int(np.bitwise_count(ones).sum())
            if have + n > k:
                open_ = ones
            else:
                sure |= ones
                have += n
                open_ &= ~s
                if have == k:
                    return sure, np.zeros_like(alive)
        return sure, open_


def _rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def search_block(index: Slices, ids: np.ndarray, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of a query's best rows in a block; ids are ascending.
    Scores of more than 62 bits come as Python integers."""
    size = min(len(query), index.dims)
    padded = np.zeros(index.dims, np.int64)
    padded[:size] = query[:size]
    slices, constant = index.score(padded)
    alive = index.exists.copy()
    lo, hi = np.searchsorted(ids, [own, own + 1])
    for i in range(lo, hi):
        alive[i // 64] &= ~np.uint64(1 << (i % 64))
    sure, boundary = index.top(slices, k, alive)
    rows = _rows_of(sure)
    if len(rows) < k:
        rows = np.concatenate([rows, _rows_of(boundary)[: k - len(rows)]])  # ids ascend with rows
    bits = (slices[:, rows // 64] >> (rows % 64).astype(np.uint64)) & np.uint64(1)
    if len(slices) > 62 or abs(constant) >> 62:
        numbers = [sum(1 << i for i in np.flatnonzero(column).tolist()) + constant for column in bits.T]
        return ids[rows], np.array(numbers, object)
    weights = np.uint64(1) << np.arange(len(slices), dtype=np.uint64)
    return ids[rows], (bits * weights[:, None]).sum(axis=0).astype(np.int64) + constant


def _words(scores: np.ndarray) -> dict[str, np.ndarray]:
    """The score as a long, and words (signed, then two of 63 bits) that order
    as the exact scores do."""
    if scores.dtype != object:
        return {"score": scores, "high": scores >> 63, "mid": (scores >> 63) & _LOW, "low": scores & _LOW}
    whole = scores.tolist()
    columns = {
        "score": [min(max(x, -_LOW - 1), _LOW) for x in whole], "high": [x >> 126 for x in whole],
        "mid": [x >> 63 & _LOW for x in whole], "low": [x & _LOW for x in whole],
    }
    return {name: np.array(values, np.int64) for name, values in columns.items()}


def _packed(vectors: DataFrame, blocks: int) -> DataFrame:
    """(block, dims, ids, vals): arrays of the rows of each block, in
    the order of their ids.  A block has BLOCK_ROWS rows or so."""

    def pack(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        by = np.argsort(ids, kind="stable")
        lists = table.column("q").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        dims = int(sizes.max())
        values = np.zeros((len(ids), dims), np.int64)
        values[np.arange(dims)[None, :] < sizes[:, None]] = lists.flatten().to_numpy()
        return pa.table({
            "block": table.column("block").slice(0, 1), "dims": pa.array([dims]),
            "ids": pa.array([ids[by].tobytes()], pa.binary()), "vals": pa.array([values[by].tobytes()], pa.binary()),
        })

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id", "q"), F.lit(blocks)))
    return dealt.groupBy("block").applyInArrow(pack, "block long, dims long, ids binary, vals binary")


def _unpack(ids: bytes, values: bytes, dims: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(values, np.int64).reshape(len(ids) // 8, dims)


def _search(batches, k: int):
    """Rows of (query block, candidate block) -> the best of each pair."""
    last, index, ids = None, None, None
    for batch in batches:
        for r in batch.to_pylist():
            if r["block"] != last:
                ids, rows = _unpack(r["ids"], r["vals"], r["dims"])
                index, last = Slices(rows), r["block"]
            own, queries = _unpack(r["q_ids"], r["q_vals"], r["q_dims"])
            best = [search_block(index, ids, q, int(o), k) for o, q in zip(own, queries, strict=True)]
            counts = [len(b[0]) for b in best]
            yield pa.record_batch({
                "query_id": pa.array(np.repeat(own, counts)),
                "vec_id": pa.array(np.concatenate([b[0] for b in best])),
                **{name: pa.array(values) for name, values in _words(np.concatenate([b[1] for b in best])).items()},
            })


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """Quantised (vec_id, q) against quantised (vec_id, q): the k best of each
    query as (query_id, rank, vec_id, score)."""
    held = cut_lineage(vectors)
    blocks = -(-held.count() // BLOCK_ROWS) or 1
    asked = cut_lineage(_packed(queries, -(-queries.count() // QUERY_ROWS) or 1))
    each = asked.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.col("dims").alias("q_dims"), F.col("ids").alias("q_ids"), F.col("vals").alias("q_vals"),
    )
    pairs = _packed(held, blocks).join(each, "block")
    found = pairs.mapInArrow(lambda batches: _search(batches, k), "query_id long, vec_id long, score long, high long, mid long, low long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("high"), F.desc("mid"), F.desc("low"), "vec_id"))
    return found.distinct().withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_bitsliced_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantise(read(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.filter(F.col("vec_id") % QUERY_EVERY == 0))


ORACLE_SQL = f"""
WITH f AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS q FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
v AS (SELECT vec_id, list_transform(q, lambda x: CASE WHEN x >= 9223372036854775807::DOUBLE THEN 9223372036854775807::HUGEINT
    WHEN x < -9223372036854775808::DOUBLE THEN -9223372036854775808::HUGEINT ELSE x::HUGEINT END) AS q FROM f),
s AS (SELECT a.vec_id AS query_id, b.vec_id, coalesce(list_sum(list_transform(list_zip(a.q, b.q, true), lambda z: z[1] * z[2])), 0) AS exact
    FROM v a JOIN v b ON a.vec_id % {QUERY_EVERY} = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY exact DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id,
    greatest(least(exact, 9223372036854775807), -9223372036854775808)::BIGINT AS score FROM r WHERE rank <= {K}
"""

"""SimHash near-duplicate groups over pigeonhole blocks.

A fingerprint has a bit set where more than half of the XXH64 hashes (seed
42) of the text's 3-word shingles have it set.  Two fingerprints link at
``max_distance`` differing bits or fewer; groups are the connected
components of the links.

Pigeonhole: the 64 bits are cut into ``max_distance + SPARE`` blocks.  Two
close fingerprints differ in at most ``max_distance`` of them, so they agree
in ``SPARE`` blocks at least; every choice of SPARE blocks gives one join key
of 38 bits or so (for distance 2: 5 blocks, 10 keys), and candidates that
share a key are verified by their Hamming distance.

Documents with equal fingerprints are one vertex (its smallest id), so a
group of exact copies costs one row.  A key that more than ``BUCKET_LIMIT``
different fingerprints share is not paired off: its members differ only in
the bits outside the key, so each goes to the points at up to half the
distance from it in those bits, and is linked to the smallest fingerprint at
each point.  Two members are within the distance exactly if they have such a
point in common (for an odd distance, a point with one bit left open).  This
is linear in the bucket, loses no link, and the verification still follows.

Defined results: null ids take no part in the choice of the smallest id (a
group of nulls alone has a null id) but their rows are returned; null and empty texts have fingerprint zero; repeated
rows are one vertex; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.llm.components import components
from equiscope.llm.rows import cut_lineage, map_texts, read
from equiscope.llm.text import Texts
from equiscope.llm.xxh64 import xxh64_spans

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SPARE = 3
BUCKET_LIMIT = 16


def text_fingerprints(texts: list[bytes | None], shingle: int = SHINGLE_WORDS) -> np.ndarray:
    """Signed 64-bit fingerprints.  Fewer words than a shingle: the whole
    sequence is one shingle; no words: zero."""
    x = Texts([b" ".join((t or b"").lower().split()) for t in texts])
    at = x.windows(shingle)
    starts, ends, of = x.starts[at], x.ends[at + shingle - 1], x.word_text[at]
    short = np.flatnonzero((x.counts > 0) & (x.counts < shingle))
    starts = np.concatenate([starts, x.starts[x.bounds[short]]])
    ends = np.concatenate([ends, x.ends[x.bounds[short + 1] - 1]])
    by = np.argsort(np.concatenate([of, short]), kind="stable")
    hashes = xxh64_spans(x.buf, starts[by], (ends - starts)[by])
    counts = np.maximum(x.counts - shingle + 1, (x.counts > 0).astype(np.int64))
    out = np.zeros((x.n, 64), np.uint8)
    some = np.flatnonzero(counts)
    if len(some):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        first = np.concatenate([[0], np.cumsum(counts[some])[:-1]])
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int32)
        out[some] = 2 * ones > counts[some, None]
    return np.packbits(out, axis=1, bitorder="little").view("<i8").ravel()


def fingerprints(docs: DataFrame, text: str = "text", keep: list[str] | None = None, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(row struct of the kept columns, fingerprint long)."""
    return map_texts(
        docs, lambda: lambda texts: {"fingerprint": text_fingerprints(texts, shingle)}, "fingerprint long", text, keep
    )


def _keys(fp: Column, max_distance: int) -> tuple[Column, dict[int, int]]:
    """Array of (number of the choice, bits of the chosen blocks), and the
    mask of each choice."""
    n = max_distance + SPARE
    cuts = [64 * i // n for i in range(n + 1)]
    masks = {}
    for k, chosen in enumerate(combinations(range(n), SPARE)):
        mask = sum((1 << cuts[i + 1]) - (1 << cuts[i]) for i in chosen)
        masks[k] = mask - (1 << 64) if mask >> 63 else mask
    return F.array(*[F.struct(F.lit(k).alias("choice"), fp.bitwiseAND(F.lit(m)).alias("bits")) for k, m in masks.items()]), masks


def _close(a: str, b: str, max_distance: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_distance


def close_pairs(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(fp long), distinct -> (a, b), a < b: pairs within the distance that
    connect whatever all such pairs connect."""
    keys, masks = _keys(F.col("fp"), max_distance)
    entries = prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.choice", "k.bits")
    sizes = entries.groupBy("choice", "bits").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = cut_lineage(entries.join(sizes, ["choice", "bits"]))

    few = members.filter(F.col("size") <= BUCKET_LIMIT).select("choice", "bits", "fp")
    near = few.select("choice", "bits", F.col("fp").alias("a")).join(
        few.select("choice", "bits", F.col("fp").alias("b")), ["choice", "bits"]
    )
    pairs = near.filter((F.col("a") < F.col("b")) & _close("a", "b", max_distance)).select("a", "b")

    many = members.filter(F.col("size") > BUCKET_LIMIT).select("choice", "bits", "fp")
    free = F.lit(None)
    for k, mask in masks.items():
        outside = [F.lit(1 << i if i < 63 else -(1 << 63)) for i in range(64) if not (mask >> i) & 1]
        free = F.when(F.col("choice") == k, F.array(*outside)).otherwise(free)
    points = many.withColumns({"point": F.col("fp"), "hole": F.lit(0).cast("long")})
    for _ in range(max_distance // 2):
        points = points.withColumn("flip", F.explode(F.concat(F.array(F.lit(0).cast("long")), free)))
        points = points.withColumn("point", F.col("point").bitwiseXOR(F.col("flip"))).drop("flip").distinct()
    if max_distance % 2:
        points = points.withColumn("hole", F.explode(free))
        points = points.withColumn("point", F.col("point").bitwiseAND(F.bitwise_not("hole")))
    where = ["choice", "bits", "point", "hole"]
    least = points.groupBy(*where).agg(F.min("fp").alias("a"))
    starred = (
        points.join(least, where)
        .select("a", F.col("fp").alias("b"))
        .filter((F.col("a") < F.col("b")) & _close("a", "b", max_distance))
    )
    return pairs.union(starred).distinct()


def near_groups(prints: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, fingerprint) -> (fingerprint, component_id), one row per
    different fingerprint; component_id is the smallest doc_id of the group."""
    vertices = cut_lineage(prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least")))
    groups = components(close_pairs(vertices.select("fp"), max_distance))
    of = vertices.join(groups.select(F.col("id").alias("fp"), "component"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    smallest = of.groupBy("component").agg(F.min("least").alias("component_id"))
    return of.join(smallest, "component").select(F.col("fp").alias("fingerprint"), "component_id")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_distance: int = MAX_DISTANCE,
                    shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fingerprint long, component_id) for every row."""
    prints = cut_lineage(
        fingerprints(docs, text, [doc_id], shingle).select(F.col("row").getField(doc_id).alias("doc_id"), "fingerprint")
    )
    return prints.join(near_groups(prints, max_distance), "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group, the one with the smallest id, with all
    its columns.  Rows that repeat an id are one document: the one with the
    smallest text stays (nulls first, then ties by a hash of the other
    columns).  Rows with a null id cannot be told apart by it; they all stay."""
    found = near_duplicates(docs, doc_id, text)
    first = found.filter("doc_id = component_id").select(F.col("doc_id").alias(doc_id)).distinct()
    chosen = docs.join(first, doc_id, "left_semi")
    whole = F.struct(*[chosen[f"`{c}`"] for c in docs.columns]).alias("row")
    others = [chosen[f"`{c}`"].cast("string") for c in docs.columns if c != text]
    order = F.struct(chosen[text].alias("text"), F.xxhash64(*others).alias("h")).alias("by")
    one = chosen.select(chosen[doc_id].alias("id"), whole, order).groupBy("id").agg(F.min_by("row", "by").alias("row"))
    return one.select("row.*").unionByName(docs.filter(docs[doc_id].isNull()))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))

"""Toxicity severity by cumulative-link ordinal regression.

``P(grade <= k | x) = logistic(threshold_k - w . x)``: one weight vector is
shared by all ordered thresholds.  ``x`` has an entry 1 for every hashed
lower-case word (run of ASCII letters and digits and of non-ASCII
characters) that the text holds, and for the beginnings (``PREFIXES`` bytes)
of longer words, which inflected and compound forms share.  The output is the expected severity
``sum_k P(grade > k)`` and the probability of any toxicity.

Grades of a labelled document: 0 not toxic, 1 toxic, 2 toxic and of low
quality.  The model is fitted on a sample of labelled documents of bounded
size (``SAMPLE_TOXIC`` and ``SAMPLE_CLEAN``, chosen by the hash of the id
among the labelled documents that are in the table), each weighted by the labelled documents of its class that it stands for,
and of bounded features (``FEATURES``, the words most strongly tied to
toxicity in the sample); the lasso penalty leaves a few of them.  Every
document is scored, whole.

Defined results: null and empty texts have no words, so they get the
severity of the thresholds alone; repeated label rows of a document count
once, with their highest values; null labels count as 0; without any toxic
label the severity is 0 for all; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.llm.rows import cut_lineage, map_texts, read
from equiscope.llm.text import LOWER, NOT_ALNUM, U64, Texts

BUCKETS = 1 << 18
PREFIXES = (5, 7)
SAMPLE_TOXIC = 3000
SAMPLE_CLEAN = 5000
FEATURES = 1024
GRADES = 3
#: A word is a feature if it stands in so many sampled documents and its tie
#: to toxicity is this many standard deviations from chance (labels are noisy
#: and most words are rare, so weaker ties are accidents).
MIN_DOCS = 5
MIN_TIE = 6.0
LASSO = 1e-4
ROUNDS = 500
#: Documents at least this likely to be toxic at all are toxic, if their words
#: speak for it (a score over 0; the thresholds alone condemn no text).
REJECT_FROM = 0.5


@dataclass
class OrdinalModel:
    weights: np.ndarray  # float32 by bucket
    thresholds: np.ndarray  # ascending, one per grade but the last

    def exceed(self, score: np.ndarray) -> np.ndarray:
        """P(grade > k) for every threshold k, as columns."""
        return 1.0 / (1.0 + np.exp(np.clip(self.thresholds[None, :] - score[:, None], -500, 500)))


def features(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, text) of every word and of the word beginnings."""
    x = Texts(texts, separators=NOT_ALNUM, fold=LOWER)
    of = x.word_text
    found, owners = [x.word_hashes()], [of]
    for n in PREFIXES:
        longer = x.ends - x.starts > n
        found.append(x.word_hashes(n, n)[longer])
        owners.append(of[longer])
    return (np.concatenate(found) & U64(BUCKETS - 1)).astype(np.int64), np.concatenate(owners)


def distinct_buckets(texts: list[bytes | None]) -> dict:
    """The different buckets of every text, as lists."""
    bucket, of = features(texts)
    pairs = np.unique(of * BUCKETS + bucket)
    ends = np.searchsorted(pairs, np.arange(len(texts) + 1) * BUCKETS)
    return {"buckets": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array((pairs % BUCKETS).astype(np.int32)))}


def grades(labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(id, grade), one row per labelled document."""
    toxic, low = F.max(F.coalesce("toxic", F.lit(0))), F.min(F.coalesce("quality", F.lit(1)))
    return (
        labels.filter(F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.when(toxic > 0, F.when(low > 0, 1).otherwise(2)).otherwise(0).alias("grade"))
    )


def training_sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, float, float]:
    """(grade, buckets) of the sampled documents, equal ones once, and how many
    labelled documents a clean and a toxic one of them stands for."""
    here = grades(labels, doc_id).join(docs.select(docs[doc_id].alias("id")), "id", "left_semi")
    graded = cut_lineage(here.withColumn("h", F.xxhash64("id")))
    counts = {r["toxic"]: r["n"] for r in graded.groupBy((F.col("grade") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic = graded.filter("grade > 0").orderBy("h", "id").limit(SAMPLE_TOXIC)
    clean = graded.filter("grade = 0").orderBy("h", "id").limit(SAMPLE_CLEAN)
    sample = cut_lineage(toxic.union(clean).select("id", "grade"))  # SAMPLE_TOXIC + SAMPLE_CLEAN rows at most
    taken = docs.select(docs[doc_id].alias("id"), docs[text].alias("text")).join(F.broadcast(sample), "id")
    found = map_texts(taken, lambda: distinct_buckets, "buckets array<int>", "text", ["grade"])
    stands_for = (max(counts.get(t, 0) / cap, 1.0) for t, cap in ((False, SAMPLE_CLEAN), (True, SAMPLE_TOXIC)))
    return cut_lineage(found.select("row.grade", "buckets").dropDuplicates(["grade", "buckets"])), *stands_for


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> OrdinalModel:
    sample, per_clean, per_toxic = training_sample(docs, labels, doc_id, text)
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy((F.col("grade") > 0).alias("toxic")).agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(True, 0), sizes.get(False, 0)
    if not n1 or not n0:
        return OrdinalModel(np.zeros(BUCKETS, np.float32), np.full(GRADES - 1, -50.0 if n1 else 50.0))
    by_word = sample.select(F.explode("buckets").alias("bucket"), "grade").groupBy("bucket").agg(
        F.sum(F.when(F.col("grade") > 0, 1).otherwise(0)).alias("in_toxic"), F.count(F.lit(1)).alias("in_all")
    )
    p = F.col("in_all") / (n0 + n1)
    tie = F.abs(F.col("in_toxic") - n1 * p) / F.sqrt(n1 * n0 / (n0 + n1) * p * (1 - p) + 1e-9)
    strong = by_word.filter((F.col("in_all") >= MIN_DOCS) & (tie >= MIN_TIE))
    top = [r["bucket"] for r in strong.orderBy(tie.desc(), "bucket").limit(FEATURES).collect()]
    picked = F.array(*[F.lit(b) for b in top]) if top else F.array().cast("array<int>")
    rows = sample.select("grade", F.array_intersect("buckets", picked).alias("b")).toArrow()
    place = np.full(BUCKETS, -1)
    place[np.array(top, np.int64)] = np.arange(len(top))
    lists = rows.column("b").combine_chunks()
    grade = rows.column("grade").to_numpy().astype(np.int64)
    x = np.zeros((len(grade), len(top)), np.float32)
    owner = np.repeat(np.arange(len(grade)), np.diff(lists.offsets.to_numpy()))
    x[owner, place[lists.flatten().to_numpy()]] = 1
    w, thresholds = fit_ordinal(x, grade, GRADES, weight=np.where(grade > 0, per_toxic, per_clean))
    weights = np.zeros(BUCKETS, np.float32)
    weights[np.array(top, np.int64)] = w
    return OrdinalModel(weights, thresholds)


def fit_ordinal(x: np.ndarray, grade: np.ndarray, n_grades: int, lasso: float = LASSO, rounds: int = ROUNDS, weight=None):
    """(weights, thresholds) by accelerated proximal gradient steps on the
    mean negative log likelihood plus ``lasso`` times the weights' 1-norm;
    rows count ``weight`` times."""
    share = np.ones(len(grade)) if weight is None else np.asarray(weight, float)
    n = share.sum()
    upto = np.array([(share[grade <= k].sum() + 0.5) / (n + 1) for k in range(n_grades - 1)])
    t = np.log(upto / (1 - upto))
    for k in range(1, n_grades - 1):
        t[k] = max(t[k], t[k - 1] + 1e-3)
    w = np.zeros(x.shape[1], np.float32)
    v = np.ones(x.shape[1], np.float32)
    for _ in range(20):  # largest curvature, by power iteration
        v = x.T @ (x @ v * share).astype(np.float32) / n
        size = float(np.linalg.norm(v)) or 1.0
        v /= size
    step = 1.0 / (0.25 * size + 0.5)
    look, look_t, speed = w, t, 1.0
    big = 40.0
    for _ in range(rounds):
        s = x @ look
        edges = np.concatenate([[-big], look_t, [big]])
        hi = 1 / (1 + np.exp(np.clip(s - edges[grade + 1], -big, big)))
        lo = 1 / (1 + np.exp(np.clip(s - edges[grade], -big, big)))
        p = np.maximum(hi - lo, 1e-9)
        d_hi, d_lo = share * hi * (1 - hi) / p, share * lo * (1 - lo) / p
        grad_w = (x.T @ (d_hi - d_lo).astype(np.float32)) / n
        grad_t = np.array([(-(d_hi[grade == k]).sum() + d_lo[grade == k + 1].sum()) / n for k in range(n_grades - 1)])
        moved = look - step * grad_w
        new_w = np.sign(moved) * np.maximum(np.abs(moved) - step * lasso, 0).astype(np.float32)
        new_t = np.maximum.accumulate(look_t - step * grad_t + 1e-6 * np.arange(n_grades - 1))
        new_speed = (1 + np.sqrt(1 + 4 * speed**2)) / 2
        pull = (speed - 1) / new_speed
        look, look_t = new_w + np.float32(pull) * (new_w - w), np.maximum.accumulate(new_t + pull * (new_t - t))
        w, t, speed = new_w, new_t, new_speed
    return w, t


def severity(docs: DataFrame, model: OrdinalModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, expected_severity, p_toxic, toxic)."""

    def run(texts):
        bucket, of = features(texts)
        hit = np.flatnonzero(model.weights[bucket])
        pairs = np.unique(of[hit] * BUCKETS + bucket[hit])
        score = np.bincount(pairs // BUCKETS, model.weights[pairs % BUCKETS], minlength=len(texts))
        above = model.exceed(score)
        toxic = (above[:, 0] >= REJECT_FROM) & (score > 0)
        return {"expected_severity": above.sum(1), "p_toxic": above[:, 0], "toxic": toxic}

    return map_texts(docs, lambda: run, "expected_severity double, p_toxic double, toxic boolean", text, keep)


def keep_clean(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not toxic, with all their columns."""
    model = fit(docs, labels, doc_id, text)
    return severity(docs, model, text).filter("not toxic").select("row.*")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    model = fit(docs, read(spark, sf_dir, "labels"))
    return severity(docs, model, keep=["doc_id"]).select(
        "row.doc_id", "expected_severity", "p_toxic", "toxic"
    )

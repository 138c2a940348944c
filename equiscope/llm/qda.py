"""Quality classifier: regularised quadratic discriminant analysis.

A document becomes ``FEATURES`` transformed statistics of its whole text: the
log of its number of words, mean word length, and square roots of shares
(capitals, symbols, exclamation marks, digits, stops, line feeds, short
words, words equal to the one before, different words).  Each quality class
is a Gaussian over them.  Its covariance is shrunk twice: towards the
covariance pooled over the classes (``TO_POOLED``) and towards a multiple of
the pooled variances (``TO_DIAGONAL``).  A score is

    P(label 1 | x) = logistic(slope * (log N1(x) - log N0(x) + log prior odds) + shift)

where the log densities come from Mahalanobis distances: the inverse
Cholesky factor of each class is computed once on the driver and travels to
the tasks (``len(FEATURES)**2`` numbers a class).  Labels are noisy and no
class is quite Gaussian, so the raw difference is far too sure of itself;
``slope`` and ``shift`` are the logistic regression of the training labels on
it, from a histogram of the difference (``STEPS`` cells a class at most).

Fitting reads every labelled training document, no sample: Spark adds up the
counts, sums and products of whole-number features (multiples of
``1 / SCALE``), so the moments are exact and do not depend on the partitions.
Equal texts of one label count once.

Defined results: a null text is an empty one and is scored like any other;
repeated label rows of a document count once, with their lowest quality; null
labels and labels without a document are ignored; a document with a null id
is never used for learning and counts as not held out; without training
rows of both classes every score is the share of label 1 (0.5 without any
label).  Repeated rows get equal scores.  An empty table gives an empty
result.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from equiscope.llm.rows import cut_lineage, map_texts, read
from equiscope.llm.text import U64, Texts, mix, per_text_sum

FEATURES = (
    "log_words", "word_length", "capitals", "symbols", "exclamations", "digits", "stops", "line_feeds",
    "short_words", "repeats", "different",
)
SHORT_WORD = 3
#: Share of the pooled covariance, and then of the pooled variances, in a class covariance.
TO_POOLED = 0.10
TO_DIAGONAL = 0.10
#: Features are whole multiples of 1 / SCALE.
SCALE = 1 << 12
#: Log density differences are clipped here and counted in steps for the calibration.
CLIP = 60.0
STEPS = 1 << 10
KEEP_FROM = 0.7
HELD_OUT = 2
FOLDS = 4

_B = np.arange(256)
_UPPER = (_B >= 65) & (_B <= 90)
_LETTER = ((_B | 32) >= 97) & ((_B | 32) <= 122) | (_B >= 192)
_DIGIT = (_B >= 48) & (_B <= 57)
_SYMBOL = np.isin(_B, list(b"#*$%&|<>@^~`+=\\_{}[]"))
_EXCLAIM = np.isin(_B, list(b"!?"))
_STOP = np.isin(_B, list(b".,;:"))


def statistics(texts: list[bytes | None]) -> np.ndarray:
    """A row of FEATURES for every text, in whole multiples of 1 / SCALE."""
    x = Texts(texts)
    bounds = np.append(x.text_starts, len(x.buf))

    def count(table):
        return per_text_sum(table[x.buf].astype(np.int64), bounds)

    n = x.counts.astype(np.float64)
    word_hash, of = x.word_hashes(), x.word_text
    again = np.zeros(len(of), np.int64)
    again[1:] = (word_hash[1:] == word_hash[:-1]) & (of[1:] == of[:-1])
    keys = np.unique(mix(word_hash ^ mix(of.astype(U64) + U64(1))), return_index=True)[1]
    different = np.bincount(of[keys], minlength=x.n)
    size = x.ends - x.starts
    lead = count((_B & 0xC0) != 0x80) - count(_B <= 32)
    letters = count(_LETTER)

    def share(part, whole):
        return np.sqrt(part / (whole + 1.0))

    found = [
        np.log1p(n),
        np.log((np.maximum(lead, 0) + 5.0) / (n + 1.0)),
        share(count(_UPPER), letters),
        share(count(_SYMBOL), n),
        share(count(_EXCLAIM), n),
        share(count(_DIGIT), n),
        share(count(_STOP), n),
        share(count(_B == 10) - 1, n),  # Texts puts one line feed behind every text
        share(per_text_sum((size <= SHORT_WORD).astype(np.int64), x.bounds), n),
        share(per_text_sum(again, x.bounds), n),
        np.log1p(different) / np.log(n + 2.0),
    ]
    return np.rint(np.stack(found, 1) * SCALE).astype(np.int64)


@dataclass
class Discriminant:
    """Means, inverse Cholesky factors and log normalisers by class, and the
    calibration.  Without both classes there are no densities, and ``share``
    is the score of every text."""

    means: np.ndarray | None
    factors: np.ndarray | None
    logs: np.ndarray | None
    share: float
    slope: float = 1.0
    shift: float = 0.0

    def difference(self, features: np.ndarray) -> np.ndarray:
        """Log density of label 1 less that of label 0, plus the log prior odds."""
        x = features / SCALE
        log_p = [
            self.logs[k] - 0.5 * np.square((x - self.means[k]) @ self.factors[k].T).sum(1) for k in (0, 1)
        ]
        return log_p[1] - log_p[0]

    def score(self, features: np.ndarray) -> np.ndarray:
        if self.means is None:
            return np.full(len(features), self.share)
        z = self.slope * np.clip(self.difference(features), -CLIP, CLIP) + self.shift
        return 1.0 / (1.0 + np.exp(-z))


def discriminant(n: np.ndarray, sums: np.ndarray, products: np.ndarray) -> Discriminant:
    """From the count, sums and sums of products of each class's features
    (in units of 1 / SCALE; class 0 first)."""
    if not n.min():
        return Discriminant(None, None, None, float(n[1] / n.sum()) if n.sum() else 0.5)
    means = sums / n[:, None] / SCALE
    scatter = products / SCALE**2 - n[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(0) / max(n.sum() - 2, 1)
    floor = np.diag(np.maximum(np.diag(pooled), 1.0 / SCALE))
    factors, logs = [], []
    for k in (0, 1):
        own = ((1 - TO_POOLED) * scatter[k] + TO_POOLED * n[k] * pooled) / n[k]
        lower = np.linalg.cholesky((1 - TO_DIAGONAL) * own + TO_DIAGONAL * floor)
        factors.append(np.linalg.inv(lower))
        logs.append(np.log(n[k] / n.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.stack(factors), np.array(logs), float(n[1] / n.sum()))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text leaves HELD_OUT modulo FOLDS; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def described(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row struct of the kept columns, h: 64-bit hash of the text, x: its
    statistics).  The texts go no further than this: what is joined with the
    labels and what is scored is some fifty bytes a document."""

    def run(texts):
        rows = statistics(texts)
        ends = np.arange(len(rows) + 1, dtype=np.int32) * len(FEATURES)
        return {"x": pa.ListArray.from_arrays(pa.array(ends), pa.array(rows.ravel().astype(np.int32)))}

    kept = docs.columns if keep is None else keep
    held = docs.select(
        F.struct(*[docs[f"`{c}`"] for c in kept]).alias("held"), F.xxhash64(docs[text]).alias("h"), docs[text].alias("text")
    )
    found = map_texts(held, lambda: run, "x array<int>", "text", ["held", "h"])
    return found.select(F.col("row.held").alias("row"), "row.h", "x")


def training_rows(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """(label, h, x) of the labelled training documents; equal texts of a
    label once."""
    known = (
        labels.filter(F.col("quality").isNotNull() & F.col(doc_id).isNotNull())
        .groupBy(F.col(doc_id).alias("id"))
        .agg(F.min("quality").alias("label"))
        .filter(~held_out(F.col("id")))
    )
    taken = rows.select(F.col("row").getField(doc_id).alias("id"), "h", "x").filter(~held_out(F.col("id")))
    found = taken.join(known, "id").select((F.col("label") > 0).cast("int").alias("label"), "h", "x")
    return found.groupBy("label", "h").agg(F.first("x").alias("x"))


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count, sums and products by class: one row per class and cell of a
    (1 + features) squared matrix reaches the driver."""
    d = len(FEATURES) + 1

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column(0).to_numpy()
            x = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(len(label), d - 1)
            x = np.concatenate([np.ones((len(x), 1), np.int64), x], 1)
            total = [(x[label == k].T @ x[label == k]).ravel() for k in (0, 1)]
            yield pa.record_batch(
                {
                    "label": pa.array(np.repeat(np.arange(2, dtype=np.int32), d * d)),
                    "cell": pa.array(np.tile(np.arange(d * d, dtype=np.int32), 2)),
                    "value": pa.array(np.concatenate(total)),
                }
            )

    parts = rows.select("label", "x").mapInArrow(add, "label int, cell int, value long")
    whole = parts.groupBy("label", "cell").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    full = np.zeros((2, d * d))
    for r in whole.collect():
        full[r["label"], r["cell"]] = float(r["value"])
    full = full.reshape(2, d, d)
    return full[:, 0, 0], full[:, 0, 1:], full[:, 1:, 1:]


def calibration(rows: DataFrame, model: Discriminant) -> tuple[float, float]:
    """Slope and shift of the logistic regression of the label on the clipped
    difference, by Newton steps on the histogram; the slope stays above 0."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            step = np.rint((np.clip(model.difference(x), -CLIP, CLIP) / CLIP + 1) / 2 * (STEPS - 1))
            yield pa.record_batch({"label": batch.column(0), "step": pa.array(step.astype(np.int32))})

    steps = rows.select("label", "x").mapInArrow(run, "label int, step int").groupBy("label", "step").agg(
        F.count(F.lit(1)).alias("n")
    )
    got = sorted(tuple(r) for r in steps.collect())  # at most 2 * STEPS rows
    label, step, n = (np.array(v, float) for v in zip(*got, strict=True))
    z = (step / (STEPS - 1) * 2 - 1) * CLIP
    x = np.stack([z, np.ones_like(z)], 1)
    w = np.array([0.05, np.log((n[label > 0].sum() + 1) / (n[label == 0].sum() + 1))])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        grad = x.T @ (n * (p - label)) + 1e-3 * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        move = np.linalg.solve(hess, grad)
        w = w - move * min(1.0, 1.0 / (np.abs(move) * [4, 1]).max() if move.any() else 1.0)
        if np.abs(move).max() < 1e-9:
            break
    return max(float(w[0]), 1e-3), float(w[1])


def fit(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id") -> Discriminant:
    """The model of :func:`described` documents and their labels."""
    known = cut_lineage(training_rows(rows, labels, doc_id))
    model = discriminant(*moments(known))
    if model.means is not None:
        model.slope, model.shift = calibration(known, model)
    return model


def score(rows: DataFrame, model: Discriminant) -> DataFrame:
    """(row, score) of :func:`described` documents."""
    kept = rows.select("row", "x")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x))], names=["row", "score"])

    return kept.mapInArrow(run, f"row {kept.schema['row'].dataType.simpleString()}, score double")


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row struct of the kept columns, score): every text is read once."""
    rows = cut_lineage(described(docs, text, keep))
    return score(rows, fit(rows, labels, doc_id))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"), keep=["doc_id"])
    return scored.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score").withColumn(
        "predicted", (F.col("score") >= KEEP_FROM).cast("int")
    )

import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from equiscope.llm import qda

LABELS = "doc_id long, quality int, toxic int"
SYMBOLS = "#*$%&|<>@^~`+=\\_{}[]"


def plain_statistics(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0d]+", text) if w]
    n = len(words)

    def share(part, whole):
        return math.sqrt(part / (whole + 1))

    letters = sum(c.isascii() and c.isalpha() or ord(c) > 127 for c in text)
    return [
        math.log1p(n),
        math.log((sum(ord(c) > 32 for c in text) + 5) / (n + 1)),
        share(sum("A" <= c <= "Z" for c in text), letters),
        share(sum(c in SYMBOLS for c in text), n),
        share(sum(c in "!?" for c in text), n),
        share(sum("0" <= c <= "9" for c in text), n),
        share(sum(c in ".,;:" for c in text), n),
        share(text.count("\n"), n),
        share(sum(len(w.encode()) <= qda.SHORT_WORD for w in words), n),
        share(sum(a == b for a, b in zip(words, words[1:])), n),
        math.log1p(len(set(words))) / math.log(n + 2),
    ]


ODD = [None, "", " \n\t", "a", "A a A a a", "é É ß 中 🎉", "#$% !! 12,3. \n\n", "x" * 100_000, "the cat " * 20_000, "\n\n\n"]


def test_statistics_against_plain_version(spark, sf):
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    got = qda.statistics([None if t is None else t.encode() for t in texts]) / qda.SCALE
    assert got == pytest.approx(np.array([plain_statistics(t) for t in texts]), abs=1 / qda.SCALE)


def in_fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_densities_against_plain_version(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    model = qda.fit(qda.described(docs), labels)
    quality = {}
    for r in labels.collect():
        quality[r.doc_id] = min(r.quality, quality.get(r.doc_id, 1))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = {(quality[i], t): plain_statistics(t) for i, t in texts.items() if i in quality and not in_fold(i)}
    x = np.rint(np.array(list(rows.values())) * qda.SCALE) / qda.SCALE
    y = np.array([k for k, _ in rows])
    cov = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    n = [(y == k).sum() for k in (0, 1)]
    pooled = (n[0] * cov[0] + n[1] * cov[1]) / (len(y) - 2)
    probe = x[:50]
    logs = []
    for k in (0, 1):
        c = 0.9 * (0.9 * cov[k] + 0.1 * pooled) + 0.1 * np.diag(np.maximum(np.diag(pooled), 1 / qda.SCALE))
        away = probe - x[y == k].mean(0)
        mahalanobis = np.einsum("ij,jk,ik->i", away, np.linalg.inv(c), away)
        logs.append(math.log(n[k] / len(y)) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * mahalanobis)
    assert model.difference(probe * qda.SCALE) == pytest.approx(logs[1] - logs[0], rel=1e-6, abs=1e-6)


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    out = qda.op13_quality_classifier(spark, path)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{path}/labels.parquet").groupBy("doc_id").agg(F.min("quality").alias("q"))
    rows = out.join(labels, "doc_id").filter("held_out").collect()
    assert all(in_fold(r.doc_id) for r in rows) and len(rows) > 500
    good = sorted(r.score for r in rows if r.q == 1)
    bad = [r.score for r in rows if r.q == 0]
    assert np.mean(np.searchsorted(good, bad)) < 0.03 * len(good)  # area under the curve over 0.97
    assert np.mean([r.predicted == r.q for r in rows]) > 0.97
    assert np.mean([r.predicted for r in rows if r.q == 1]) > 0.99
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)


def test_held_out_labels_do_not_matter(spark):
    path = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.withColumn("quality", F.when(qda.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = qda.fit(qda.described(docs), labels), qda.fit(qda.described(docs.repartition(5)), turned)
    assert np.array_equal(a.means, b.means) and np.array_equal(a.factors, b.factors)
    assert (a.slope, a.shift) == (b.slope, b.shift)


def scores(docs, model):
    return qda.score(qda.described(docs), model).select("row.doc_id", "score").collect()


def test_odd_rows_and_columns(spark, docs_of):
    train = [i for i in range(400) if not in_fold(i)]
    rows = [(i, "good words in a line of text " * (1 + i % 7) if i % 2 else "BAD!! $$$ " * (3 + i % 5)) for i in train]
    odd = [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "good words"), (1, "BAD!! $$$ again"), (1, None)]
    docs = docs_of(rows + odd).withColumns({"row": F.lit("x"), "score": F.lit(3), "label": F.lit(1)})
    labels = spark.createDataFrame([(i, i % 2, 0) for i in train] + [(None, 0, 0), (1, 1, None), (5, None, 1), (10**9, 0, 0)], LABELS)
    rows_of = qda.described(docs)
    model = qda.fit(rows_of, labels)
    got = scores(docs, model)
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got if r.doc_id not in (None, 1)}
    assert min(by[i] for i in train[10:] if i % 2) > 0.7 > max(by[i] for i in train[10:] if not i % 2)
    assert by[1000] == by[1001]  # null and empty
    assert scores(docs_of([]), model) == []
    none = qda.fit(rows_of, labels.limit(0))
    assert {r.score for r in scores(docs, none)} == {0.5}
    only = qda.fit(rows_of, labels.filter("quality = 1"))
    assert {r.score for r in scores(docs, only)} == {1.0}
    empty = qda.fit(qda.described(docs_of([])), labels)
    assert scores(docs, empty)[0].score == 0.5


def test_copies_count_once(spark, docs_of):
    train = [i for i in range(900) if not in_fold(i)]
    base = [(i, " ".join(f"w{j * i % 17}" for j in range(5 + i % 40)) if i % 3 else "JUNK!! " * (5 + i % 9)) for i in train[:300]]
    labels = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i in train], LABELS)
    copies = [(i, base[1][1]) for i in train[300:] if i % 3 == base[1][0] % 3]
    a, b = (qda.fit(qda.described(docs_of(x)), labels) for x in (base, base + copies))
    assert np.array_equal(a.means, b.means) and a.slope == b.slope

import numpy as np
from pyspark.sql import functions as F

from equiscope.llm import toxicity
from equiscope.llm.toxicity import OrdinalModel, fit, fit_ordinal, grades, keep_clean, severity


def test_gradient_steps_reach_the_optimum():
    """Against a plain minimiser of the same likelihood, on dense data."""
    r = np.random.default_rng(1)
    x = (r.random((600, 5)) < 0.3).astype(np.float32)
    latent = x @ np.array([2.0, -1.0, 0.0, 1.0, 3.0]) + r.logistic(size=600)
    grade = (latent > 1.5).astype(np.int64) + (latent > 3.5)

    def loss(w, t):
        s = x @ w
        edges = np.concatenate([[-40], t, [40]])
        up, low = 1 / (1 + np.exp(s - edges[grade + 1])), 1 / (1 + np.exp(s - edges[grade]))
        return -np.log(np.maximum(up - low, 1e-12)).mean() + 1e-4 * np.abs(w).sum()

    w, t = fit_ordinal(x, grade, 3, lasso=1e-4, rounds=3000)
    best = loss(w, t)
    for _ in range(300):  # no step nearby is better
        dw, dt = r.normal(0, 0.05, 5), r.normal(0, 0.05, 2)
        assert loss(w + dw, np.sort(t + dt)) > best - 1e-5
    assert t[0] < t[1] and abs(w[4]) > abs(w[2])


def test_expected_severity_is_the_sum_over_thresholds():
    m = OrdinalModel(np.zeros(toxicity.BUCKETS, np.float32), np.array([1.0, 2.0]))
    above = m.exceed(np.array([0.0, 1.5, 9.0]))
    assert np.all(above[:, 0] > above[:, 1]) and above[1, 0] > 0.5 > above[1, 1]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = fit(docs, labels.filter("doc_id % 2 = 0"))
    scored = severity(docs, model, keep=["doc_id"]).select("row.doc_id", "expected_severity", "p_toxic")
    out = scored.join(grades(labels).filter("id % 2 = 1"), F.col("doc_id") == F.col("id")).toPandas()
    flagged, toxic = out.p_toxic >= toxicity.REJECT_FROM, out.grade > 0
    assert (flagged & toxic).sum() / flagged.sum() > 0.85
    assert (flagged & ~toxic).sum() / (~toxic).sum() < 0.02
    assert (flagged & toxic).sum() / toxic.sum() > 0.6
    order = out.expected_severity.rank()
    auc = (order[toxic].sum() - toxic.sum() * (toxic.sum() + 1) / 2) / (toxic.sum() * (~toxic).sum())
    assert auc > 0.8


def test_grades(spark):
    rows = [(1, 1, 0), (2, 1, 1), (3, 0, 1), (4, None, None), (5, 1, 0), (5, 0, 1), (None, 1, 1), (6, 0, 0)]
    got = {r.id: r.grade for r in grades(spark.createDataFrame(rows, "doc_id long, quality int, toxic int")).collect()}
    assert got == {1: 0, 2: 1, 3: 2, 4: 0, 5: 2, 6: 0}


def test_odd_rows_and_columns(spark, docs_of):
    rows = [(i, "bad" * (i % 2) + f" plain words number{i} here") for i in range(40)] + [(90, None), (91, ""), (91, ""), (None, "bad")]
    docs = docs_of(rows).withColumns({"row": F.lit(1), "p_toxic": F.lit("x"), "id": F.lit(2), "grade": F.lit(3)})
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(40)], "doc_id long, quality int, toxic int")
    kept = keep_clean(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [*range(0, 40, 2), 90, 91, 91] and None not in ids
    none = labels.limit(0)
    assert keep_clean(docs, none).count() == len(rows)
    assert keep_clean(docs, labels.filter("toxic = 0")).count() == len(rows)
    assert keep_clean(docs.limit(0), labels).count() == 0


def test_bound_of_the_sample_does_not_move_the_thresholds(spark, docs_of, monkeypatch):
    """Ten times as many clean documents as the sample takes: the thresholds of a fit on all."""
    r = np.random.default_rng(7)
    grade = (r.random(4000) < 0.12).astype(int)
    texts = [f"w{r.integers(400)} w{r.integers(400)} n{i} " + "bad" * (r.random() < (0.7 if g else 0.03)) for i, g in enumerate(grade)]
    docs = docs_of(list(enumerate(texts)))
    labels = spark.createDataFrame([(i, 1, int(g)) for i, g in enumerate(grade)], "doc_id long, quality int, toxic int")
    whole = fit(docs, labels)
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 350)
    bounded = fit(docs, labels)
    assert abs(bounded.thresholds[0] - whole.thresholds[0]) < 0.5
    sizes = [m.weights[m.weights > 0].sum() for m in (whole, bounded)]
    assert min(sizes) > 0


def test_labels_without_documents_take_no_place(spark, docs_of, monkeypatch):
    docs = docs_of([(i, "bad" * (i % 2) + f" plain words number{i} here") for i in range(40)])
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(4000)], "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 30)
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 30)
    kept = sorted(r.doc_id for r in keep_clean(docs, labels).collect())
    assert kept == list(range(0, 40, 2))

import numpy as np
from pyspark.sql import functions as F

from tablepulse.llm import quality
from tablepulse.llm.queries import QUERIES

from .common import prose

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    scores = {r["doc_id"]: r for r in QUERIES["op5_quality"](spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    held = [(scores[r["doc_id"]], r["quality"]) for r in labels if scores[r["doc_id"]]["held_out"]]
    assert len(held) > 40 and len(scores) == 1000
    assert np.mean([row["predicted"] == label for row, label in held]) > 0.95
    assert all(0 <= row["score"] <= 1 for row in scores.values())


def test_pool_violators_is_the_nearest_monotone_sequence():
    got = quality.pool_violators(np.array([1.0, 3, 2, 2, 5, 4]), np.array([1.0, 1, 1, 2, 1, 3]))
    assert (np.diff(got) >= 0).all()
    assert np.allclose(got, [1, 2.25, 2.25, 2.25, 4.25, 4.25])


def labelled(spark, documents, label):
    docs = documents([(i, prose(i, 30) if i % 2 else "BUY!! NOW!! " * 9) for i in range(80)])
    labels = spark.createDataFrame([(i, label(i)) for i in range(80)], "doc_id long, quality int")
    return docs, labels


def score(docs, labels):
    learn, calibrate = F.col("doc_id") % 5 != 0, F.col("doc_id") % 5 == 4
    return {
        r["doc_id"]: r for r in quality.score_quality(docs, labels, learn, calibrate).collect()
    }


def test_learns_and_handles_edges(spark, documents):
    docs, labels = labelled(spark, documents, lambda i: i % 2)
    more = documents([(900, None), (901, ""), (902, "x " * 300000), (None, "no id")])
    odd = spark.createDataFrame([(None, 1), (3, None), (900, 7)], "doc_id long, quality int")
    got = score(docs.unionByName(more), labels.union(odd))
    assert len(got) == 84
    assert all(got[i]["predicted"] == i % 2 for i in range(0, 80, 5))
    assert all(r["score"] is not None and 0 <= r["score"] <= 1 for r in got.values())


def test_without_labels_or_with_one_class(spark, documents):
    docs, ones = labelled(spark, documents, lambda i: 1)
    assert {r["score"] for r in score(docs, ones).values()} == {1.0}
    assert {r["score"] for r in score(docs, ones.limit(0)).values()} == {0.5}
    assert score(docs.limit(0), ones) == {}


def test_sums_do_not_depend_on_the_partitioning(spark, documents):
    docs, labels = labelled(spark, documents, lambda i: i % 2)
    one, many = score(docs.repartition(1), labels), score(docs.repartition(6), labels)
    assert all(abs(one[i]["score"] - many[i]["score"]) < 1e-6 for i in one)


def monotone(means, weights):
    """Isotonic regression by its min-max formula."""
    n = len(means)

    def average(i, j):
        return np.average(means[i : j + 1], weights=weights[i : j + 1])

    return np.array(
        [max(min(average(i, j) for j in range(k, n)) for i in range(k + 1)) for k in range(n)]
    )


def test_fit_and_scores_equal_a_direct_dense_computation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    texts = sorted((r["doc_id"], r["text"]) for r in docs.collect())
    stats = np.array([quality.statistics(text) for _, text in texts])
    rows = [
        (stats[at].tolist(), float(labels[doc_id]), doc_id % 5 == 4)
        for at, (doc_id, _) in enumerate(texts)
        if labels.get(doc_id) in (0, 1)
    ]
    frame = spark.createDataFrame(rows, "stats array<double>, label double, calibrate boolean")
    model = quality.fit_quality(frame.repartition(5))

    known, wanted, later = (np.array(column) for column in zip(*rows))
    mean, spread = known.mean(axis=0), known.std(axis=0)
    spread[spread == 0] = 1
    weights, shifts = quality._projection(4.0)

    def features(table):
        scaled = np.clip((table - mean) / spread, -6, 6)
        waves = np.cos(scaled @ weights + shifts) * np.sqrt(2 / len(shifts))
        return np.hstack([waves, np.ones((len(table), 1))])

    fitted = features(known[~later])
    scale = 1e-4 * (fitted**2).sum() / fitted.shape[1]
    # Ridge as least squares over rows stacked on a scaled unit matrix.
    stacked = np.vstack([fitted, np.sqrt(scale) * np.eye(fitted.shape[1])])
    target = np.append(wanted[~later], np.zeros(fitted.shape[1]))
    solution = np.linalg.lstsq(stacked, target, rcond=None)[0]
    direct = np.clip(features(stats) @ solution, 0, 1)
    assert np.allclose(model.ridge_scores(stats), direct, atol=1e-6)

    held = np.clip(features(known[later]) @ solution, 0, 1)
    bins = np.floor(held * quality.BINS)
    every = np.unique(bins)
    counts = np.array([(bins == x).sum() for x in every], float)
    shares = np.array([wanted[later][bins == x].mean() for x in every])
    knots = np.array([held[bins == x].mean() for x in every])
    level = monotone(shares, counts)
    assert np.allclose(model.knots, knots, atol=1e-6) and np.allclose(model.values, level, atol=1e-9)
    assert np.allclose(model.scores(stats), np.interp(direct, knots, level), atol=1e-4)

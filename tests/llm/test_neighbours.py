import numpy as np
from pyspark.sql import functions as F

from tablepulse.llm import neighbours

from .common import SF

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute_force(rows, every, k=20):
    out = {}
    known = {}
    for vec_id, vector in rows:
        if vec_id is None or vector is None or any(x is None or not np.isfinite(x) for x in vector):
            continue
        if any(vector):
            known[vec_id, tuple(vector)] = np.array(vector, np.float32).astype(np.float64)
    ids = np.array([key[0] for key in known])
    matrix = np.array(list(known.values()))
    for at in np.flatnonzero(ids % every == 0):
        scores = (matrix * matrix[at]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != ids[at]][:k]
        out[int(ids[at])] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def search(frame, every=20, **options):
    found = neighbours.nearest(frame, F.col("vec_id") % every == 0, **options).collect()
    out = {}
    for row in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(row["query_id"], []).append((row["vec_id"], row["score"]))
        assert row["rank"] == len(out[row["query_id"]])
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA).repartition(3)


def recall(got, want):
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got.get(q, [])}) for q in want)
    return hits / max(sum(map(len, want.values())), 1)


def test_recall_on_whole_table(spark):
    vectors = spark.read.parquet(f"{SF}/../sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    want, got = brute_force(rows, 20), search(vectors)
    assert got.keys() == want.keys() and all(len(x) == 20 for x in got.values())
    assert recall(got, want) >= 0.9
    scores = dict(rows)
    for query, near in got.items():
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
        for vec_id, score in near:
            exact = np.dot(np.array(scores[query], float), np.array(scores[vec_id], float))
            assert abs(score - exact) < 1e-12


def test_unequal_lengths_clusters_and_copies(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 3
    vectors = [
        (centres[i % 12] + rng.normal(size=16) * 0.4) * rng.uniform(0.2, 3) for i in range(1500)
    ]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(vectors)]
    rows += [(2000 + i, rows[7][1]) for i in range(700)]  # one vector in a third of all rows
    got, want = search(frame(spark, rows)), brute_force(rows, 20)
    assert got.keys() == want.keys()
    assert recall(got, want) >= 0.9
    copies = [q for q in want if q >= 2000]
    assert copies and all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in copies)


def test_blocks_of_large_buckets_and_many_cells(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 10)
    monkeypatch.setattr(neighbours, "CELL", 4096)
    rng = np.random.default_rng(2)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=8)]) for i in range(600)]
    got, want = search(frame(spark, rows)), brute_force(rows, 20)
    assert recall(got, want) >= 0.9


def test_rows_that_take_no_part(spark):
    good = [(i, [1.0, float(i), 0.5]) for i in range(8)]
    bad = [
        (20, None), (40, [0.0, 0.0, 0.0]), (60, [1.0, None, 2.0]), (80, [float("nan"), 1.0, 1.0]),
        (100, [float("inf"), 1.0, 1.0]), (120, []), (140, [1.0, 2.0]), (None, [9.0, 9.0, 9.0]),
    ]
    rows = good + bad + good[:2]
    got = search(frame(spark, rows))
    assert got == brute_force(good, 20) and list(got) == [0] and len(got[0]) == 7
    assert search(frame(spark, [(1, [1.0])])) == {}
    assert search(frame(spark, [])) == {}
    assert search(frame(spark, [(0, [1.0, 2.0])])) == {}


def test_ties_go_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(60)]
    got = search(frame(spark, rows))
    assert got[0] == [(2 * i, 1.0) for i in range(1, 21)]
    assert got[20] == [(i, 1.0) for i in [*range(0, 20, 2), *range(22, 42, 2)]]
    assert got == brute_force(rows, 20)


def test_change_list_is_in_order_and_whole():
    changes = neighbours.change_list(3, 100)
    assert len(changes) == 27 and len({tuple(row) for row in changes}) == 27
    assert not changes[0].any() and changes[1].tolist() == [1, 0, 0, 0, 0, 0]

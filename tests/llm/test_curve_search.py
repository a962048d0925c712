from itertools import product

import numpy as np

from offhours.llm.curve_search import hilbert, near_vectors, op2_curve_search

KIND = "vec_id long, embedding array<float>, score string"


def plain(rows, every, k):
    good = [
        (i, np.array(v, np.float32).astype(float)) for i, v in rows
        if i is not None and v and all(x is not None for x in v) and np.isfinite(np.array(v, float)).all() and any(v)
    ]
    out = {}
    for q, v in good:
        if q % every == 0:
            scores = [(-float(np.cumsum(v * w)[-1]), j) for j, w in good if j != q and len(w) == len(v)]
            out[q] = [(j, -s) for s, j in sorted(scores)[:k]]
    return out


def grouped(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_hilbert_steps_to_neighbours():
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        points = np.array(list(product(range(1 << bits), repeat=dims)))
        keys = hilbert(points, bits)
        assert sorted(keys) == list(range(len(points)))
        walk = points[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def recall(found, expected):
    hits = sum(len({j for j, _ in found.get(q, [])} & {j for j, _ in best}) for q, best in expected.items())
    return hits / sum(map(len, expected.values()))


def test_recall_on_given_vectors(spark):
    sf = "/root/testdata/sf0.1"
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    found, expected = grouped(op2_curve_search(spark, sf)), plain(rows, 20, 20)
    assert set(found) == set(expected)
    assert recall(found, expected) > 0.9


def test_few_vectors_are_searched_whole(spark):
    make = np.random.default_rng(5)
    rows = [(i, make.normal(size=6).astype(float).tolist()) for i in range(45)]  # unlike lengths
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], KIND)
    found = grouped(near_vectors(frame, 5, 10, ranges=1))
    assert found == plain(rows, 5, 10)


def test_copies_and_ties(spark):
    one, other = [1.0, 0.0, 2.0], [0.0, 1.0, 0.5]
    rows = [(i, one) for i in range(200)] + [(200 + i, other) for i in range(50)]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], KIND)
    assert grouped(near_vectors(frame, 20, 8, ranges=2)) == plain(rows, 20, 8)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (20, [0.0, 0.0]),
            (None, [1.0, 1.0]), (5, [3.0, -1.0]), (7, [1.0, 2.0, 3.0]), (40, []), (60, [5.0, 5.0]), (60, [5.0, 5.0])]
    frame = spark.createDataFrame([(i, v, "x") for i, v in rows], KIND)
    found = grouped(near_vectors(frame))
    assert found == {0: [(60, 15.0), (5, 1.0)], 60: [(0, 15.0), (5, 10.0)]}
    assert near_vectors(spark.createDataFrame([], KIND)).count() == 0

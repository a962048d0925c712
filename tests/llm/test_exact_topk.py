import math
import random

from offhours.llm.exact_topk import exact_top_k

KIND = "vec_id long, embedding array<float>, label int, score string"


def plain(rows, every, k):
    def whole(v):
        if v is None or any(x is None or not math.isfinite(x) for x in v):
            return None
        return [math.floor(1024 * x) for x in v]

    vectors = [(i, whole(v)) for i, v in rows if i is not None and whole(v) is not None]
    out = []
    for q in {i for i, _ in vectors if i % every == 0}:
        for i, v in vectors:
            if i == q:
                found = [(-sum(a * b for a, b in zip(v, w)), j) for j, w in vectors if j != q and len(w) == len(v)]
                out += [(q, n + 1, j, -s) for n, (s, j) in enumerate(sorted(found)[:k])]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], KIND)


def f32(x):
    import struct

    return struct.unpack("f", struct.pack("f", x))[0]


def test_equals_all_pairs(spark):
    pick = random.Random(4)
    rows = [(i, [f32(pick.gauss(0, 1)) for _ in range(40)]) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(30)]  # copies: ties by id
    rows += [(2000 + i, [f32(pick.choice([-1, 0, 1]) / 1024) for _ in range(40)]) for i in range(100)]
    for blocks in ((4096, 1024), (64, 3)):
        found = exact_top_k(frame(spark, rows), 20, 10, candidates=blocks[0], queries=blocks[1])
        assert sorted(map(tuple, found.collect())) == plain(rows, 20, 10)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
            (None, [1.0, 1.0]), (5, [3.0, -1.0]), (6, [0.0, 0.0]), (7, [1.0, 2.0, 3.0]), (100, []), (200, []),
            (300, [1.0, 2.0])]
    found = exact_top_k(frame(spark, rows), 100)
    assert sorted(map(tuple, found.collect())) == plain(rows, 100, 10)
    assert exact_top_k(frame(spark, [])).count() == 0


def test_large_components(spark):
    rows = [(0, [f32(1e14), 1.0]), (1, [f32(3e5), 1.0]), (2, [f32(3e5), f32(1.25)]), (3, [f32(1e30), 0.0])]
    found = {(r["query_id"], r["vec_id"]): r["score"] for r in exact_top_k(frame(spark, rows), 100).collect()}
    exact = {(a, b): s for a, _, b, s in plain(rows, 100, 10)}
    assert found == {pair: min(s, 2**63 - 1) for pair, s in exact.items()}
    assert found[0, 2] - found[0, 1] == 256 * 1024 if found[0, 2] < 2**63 - 1 else True

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from offhours.llm import quality
from tests.llm.edges import documents, no_documents

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r["doc_id"]: r for r in quality.op6_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    held = [(rows[x["doc_id"]]["predicted"], x["quality"]) for x in labels if rows[x["doc_id"]]["held_out"]]
    assert len(held) > 50
    assert np.mean([p == q for p, q in held]) > 0.95
    assert np.mean([p for p, q in held if q == 1]) > 0.97  # good ones stay


def test_score_is_the_logistic_of_a_dot_product():
    texts = pa.array(["a b a", "", None, "A!! b%% 12 Ü", "  \n"])
    weights = np.random.default_rng(0).normal(size=(1 << 10) + 1)
    counts, numbers = quality.features(texts, 10)
    assert counts.tolist() == [15, 0, 0, 20, 0]
    at = 0
    for n, score in zip(counts, quality.scores(texts, weights, 10)):
        x = np.bincount(numbers[at : at + n], minlength=1 << 10) * (quality.SCALE * 5 / max(1, n))
        assert score == pytest.approx(1 / (1 + np.exp(-(weights[:-1] @ x + weights[-1]))))
        at += n


def test_l1_keeps_the_model_sparse():
    texts = pa.array([f"good{i % 7} text {i}" if i % 2 else f"bad{i % 7} junk {i}" for i in range(300)])
    labels = np.array([float(i % 2) for i in range(300)])
    weights = quality.train(texts, labels, 14, 3, 1)
    p = quality.scores(texts, weights, 14)
    assert ((p > 0.5) == (labels > 0)).all()
    assert 0 < np.count_nonzero(weights) < 2000


def test_edges(spark):
    docs = documents(spark)
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (3, 1), (None, 1), (8, None), (99, 0), (9, 0)], "doc_id long, quality int"
    )
    weights = quality.fit(docs, labels)
    scored = quality.score(docs, weights, "mine")
    assert scored.columns == [*docs.columns, "mine"] and scored.count() == docs.count()
    empties = {r["mine"] for r in scored.collect() if not (r["text"] or "").split()}
    assert len(empties) == 1
    kept = quality.keep_good(docs, labels, threshold=0.0)
    assert kept.columns == docs.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))
    none = quality.fit(docs, labels.limit(0))
    assert {r["mine"] for r in quality.score(docs, none, "mine").collect()} == {0.5}
    assert quality.score(no_documents(spark), none, "mine").count() == 0
    assert quality.fit(docs, labels, sample=1).shape == weights.shape


def plain_ftrl(texts, labels, bits, epochs, seed):
    """Follow-the-regularised-leader, one feature of one example after the other."""
    rows = []
    for t in texts:
        _, numbers = quality.features(pa.array([t]), bits)
        found = Counter(numbers.tolist())
        rows.append({i: float(np.float32(c * (quality.SCALE * 5 / max(1, len(numbers))))) for i, c in found.items()})
        rows[-1][1 << bits] = 1.0  # the constant
    z, n = defaultdict(float), defaultdict(float)

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        step = (quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2
        return (math.copysign(quality.L1, z[i]) - z[i]) / step

    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for r in order.permutation(len(rows)):
            w = {i: weight(i) for i in rows[r]}
            dot = sum(w[i] * x for i, x in rows[r].items())
            p = 1 / (1 + math.exp(-max(-35.0, min(35.0, dot))))
            for i, x in rows[r].items():
                g = (p - labels[r]) * x
                sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA
                z[i] += g - sigma * w[i]
                n[i] += g * g
    out = np.zeros((1 << bits) + 1)
    for i in z:
        out[i] = weight(i)
    return out


def test_training_is_ftrl_in_plain_steps():
    pick = random.Random(8)
    words = [f"w{i}" for i in range(40)] + ["THE", "12", "a-b"]
    texts = [" ".join(pick.choice(words) for _ in range(pick.randrange(30))) for _ in range(60)] + ["", "x"]
    labels = np.array([float("w1 " in t or pick.random() < 0.3) for t in texts])
    found = quality.train(pa.array(texts), labels, 12, 3, 5)
    wanted = plain_ftrl(texts, labels, 12, 3, 5)
    assert np.allclose(found, wanted, rtol=1e-6, atol=1e-9)
    assert ((found != 0) == (wanted != 0)).all() and 0 < (found != 0).sum() < len(found) / 2

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from offhours.llm import katz
from tests.llm.edges import documents, no_documents

SF = "/root/testdata/sf0.001"


class Plain:
    """The same model in dictionaries."""

    def __init__(self, texts):
        self.c, self.pairs, self.texts = Counter(), Counter(), len(texts)
        for w in texts:
            self.c.update(w)
            self.pairs.update(zip(["<s>", *w[:-1]], w))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.wd, self.pd = self.discounts(self.c), self.discounts(self.pairs)
        freed = sum(r - self.cut(r, self.wd) for r in self.c.values())
        self.all = self.n if freed > 0 else self.n + 1
        self.unknown = (freed if freed > 0 else 1) / max(1, self.all)
        self.used, self.lower = Counter(), Counter()
        for (u, v), r in self.pairs.items():
            self.used[u] += self.cut(r, self.pd)
            self.lower[u] += self.unigram(v)

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        k = katz.K
        if n[1] and all(n[r] for r in range(1, k + 2)):
            a = (k + 1) * n[k + 1] / n[1]
            if a < 1:
                d = {r: ((r + 1) * n[r + 1] / (r * n[r]) - a) / (1 - a) for r in range(1, k + 1)}
                if all(0 < x < 1 for x in d.values()):
                    return d
        cut = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        return {r: 1 - cut / r for r in range(1, k + 1)}

    def cut(self, r, d):
        return r * d.get(r, 1)

    def unigram(self, w):
        return self.cut(self.c[w], self.wd) / self.all if self.c[w] else self.unknown

    def p(self, u, v):
        n = self.texts if u == "<s>" else self.c[u]
        if not n:
            return self.unigram(v)
        none = n - self.used[u] <= 1e-9 * n
        if r := self.pairs.get((u, v)):
            return r / (n + 1) if none else self.cut(r, self.pd) / n
        return (1 / (n + 1) if none else (n - self.used[u]) / n) / (1 - self.lower[u]) * self.unigram(v)

    def score(self, w):
        return sum(math.log10(self.p(u, v)) for u, v in zip(["<s>", *w[:-1]], w))

    def base(self, w):
        return sum(math.log10((self.c[x] + 1) / (self.n + self.v + 1)) for x in w)


def is_held(doc_id):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7 == 2


def tokens(text):
    return [*(text or "").encode().lower().split(), "</s>"]


def compare(frame, found):
    rows = [(r["doc_id"], tokens(r["text"])) for r in frame.collect()]
    model = Plain([w for i, w in rows if not is_held(i)])

    def line(i, held, n, known, total, base, score):
        return (i is None, i or 0, held, n, known, total, round(base, 6), round(score, 6))

    expected = sorted(
        line(i, is_held(i), len(w), sum(model.c[x] > 0 for x in w), model.n, model.base(w), model.score(w))
        for i, w in rows
    )
    assert sorted(line(*r) for r in found.collect()) == expected
    return model


@pytest.mark.parametrize("chunk", [4000, 10**9])
def test_equals_plain_model(spark, chunk):
    docs = spark.read.parquet(f"{SF}/documents.parquet").repartition(3)
    model = compare(docs, katz.katz_scores(docs, chunk))
    for u in ["<s>", *list(model.c)[:20]]:
        if u != "</s>":
            assert sum(model.p(u, v) for v in model.c) + model.p(u, "never seen") == pytest.approx(1)
    assert sum(map(model.unigram, model.c)) + model.unknown == pytest.approx(1)


def test_beats_the_base_on_held_out_texts(spark):
    rows = katz.op3_katz_scoring(spark, SF).where("held_out").collect()
    assert len(rows) > 10
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_edges(spark):
    docs = documents(spark)
    compare(docs, katz.katz_scores(docs, 50))
    assert katz.katz_scores(no_documents(spark)).count() == 0
    # Nothing to train on: 2 is held out.
    one = documents(spark, [(i, "a b", "en", "a") for i in range(50) if is_held(i)])
    assert {(r["score"], r["base_score"], r["train_tokens"]) for r in katz.katz_scores(one).collect()} == {(0, 0, 0)}


def test_arrays_round_trip():
    keys = np.unique(np.random.default_rng(0).integers(0, 2**64, 1000, np.uint64))
    assert (katz.unpack_keys(katz.pack_keys(keys)) == keys).all()
    for a in (np.array([], np.int32), np.array([True, False]), np.array([1.5, -2.0])):
        assert (katz.unpack(katz.pack(a), a.dtype) == a).all()


def line_fit(counts):
    """Gale's fit and Katz's discounts on it, in plain steps."""
    n = Counter(counts.values())
    rs = sorted(n)
    xs, ys = [], []
    for i, r in enumerate(rs):
        below = rs[i - 1] if i else 0
        above = rs[i + 1] if i + 1 < len(rs) else 2 * r - below
        xs.append(math.log(r))
        ys.append(math.log(n[r] / (0.5 * (above - below))))
    mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
    b = sum((x - mx) * (y - my) for x, y in zip(xs, ys)) / sum((x - mx) ** 2 for x in xs)
    k = katz.K
    a = (k + 1) * (k + 1) ** b
    return {r: ((r + 1) * ((r + 1) / r) ** b / r - a) / (1 - a) for r in range(1, k + 1)}


class Smoothed(Plain):
    discounts = staticmethod(line_fit)


def test_registered_query_is_good_turing_despite_copies(spark):
    rows = [(r["doc_id"], tokens(r["text"])) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    train = [w for i, w in rows if not is_held(i)]
    model = Smoothed(train)
    for d in (model.wd, model.pd):
        assert all(0 < x < 1 for x in d.values())
        # No discount by a fixed amount: 1 - d(r) would fall as 1 / r.
        assert not math.isclose(1 - d[1], 2 * (1 - d[2]), rel_tol=0.05)
    assert sum(map(model.unigram, model.c)) + model.unknown == pytest.approx(1)
    for u in ["<s>", *list(model.c)[:5]]:
        if u != "</s>":
            assert sum(model.p(u, v) for v in model.c) + model.p(u, "never seen") == pytest.approx(1)
    found = {r["doc_id"]: r["score"] for r in katz.op3_katz_scoring(spark, SF).collect()}
    assert found == {i: pytest.approx(model.score(w), abs=1e-6) for i, w in rows}


def test_smoothed_discounts_with_and_without_a_line():
    lifted = {1: 1000, 2: 250, 3: 110, 4: 60, 5: 400, 6: 25, 7: 20, 9: 12}  # groups of five copies
    raw = katz.discounts([0, *[lifted[r] for r in range(1, 7)]])
    assert np.allclose(raw[1:], 1 - 1000 / 1500 / np.arange(1, 6))  # the plain ones give up
    smooth = katz.smooth_discounts(lifted)[1:]
    assert (smooth > 0).all() and (smooth < 1).all() and (np.diff(smooth) > 0).all()
    for few in ({}, {3: 5}, {1: 5, 2: 50, 3: 500}):
        expected = katz.discounts([few.get(r, 0) for r in range(katz.K + 2)])
        assert (katz.smooth_discounts(few) == expected).all()

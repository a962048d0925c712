import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from offhours.llm import substring_dedup as sd
from tests.llm import edges


def brute_force(rows):
    """Every window of every document, ids in any order; null ids only against themselves."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if i is not None:
                first[key] = min(i, first.get(key, i))
    out = []
    for (i, _), w in zip(rows, words):
        gone, seen = set(), set()
        for k in range(len(w) - 19):
            key = tuple(w[k : k + 20])
            if key in seen or (i is not None and first[key] < i):
                gone |= set(range(k, k + 20))
            seen.add(key)
        kept = " ".join(x for n, x in enumerate(w) if n not in gone)
        out.append((i, len(w), len(gone), kept))
    return out


def found(df):
    return [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect()]


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, *r[1:]))


def test_cover_meets_every_difference():
    differences = {(a - b) % sd.PERIOD for a in sd.COVER for b in sd.COVER}
    assert differences == set(range(sd.PERIOD))
    assert sd.PERIOD - 1 + sd.ANCHOR == sd.WINDOW


def test_shared_passages_at_all_shifts(spark):
    """Passages of 18 to 40 words at every pair of places modulo the period."""
    pick = random.Random(4)
    rows, n = [], 0
    for shift in range(13):
        for other in range(13):
            size = pick.choice([18, 19, 20, 20, 21, 25, 40])
            passage = [f"p{n}x{k}" for k in range(size)]
            for s in (shift, other):
                around = [f"f{n}y{k}" for k in range(s + 3)]
                rows.append((n, " ".join(around[:s] + passage + around[s:])))
                n += 1
    assert ordered(found(sd.dedup_words(edges.documents(spark, [(*r, "en", "a") for r in rows])))) == brute_force(rows)


def test_random_texts_of_few_words(spark):
    """Many chance repeats, overlaps, and repeats inside of documents."""
    pick = random.Random(5)
    stock = [" ".join(pick.choice("abc") for _ in range(pick.randrange(15, 60))) for _ in range(6)]
    rows = []
    for i in pick.sample(range(1000), 60):
        parts = [pick.choice(stock) if pick.random() < 0.6 else f"u{pick.randrange(99)}" for _ in range(pick.randrange(8))]
        rows.append((i, pick.choice(["  ", "\n", " \t"]).join(parts)))
    result = ordered(found(sd.dedup_words(edges.documents(spark, [(*r, "en", "a") for r in rows]))))
    assert result == ordered(brute_force(rows))
    assert any(r[2] for r in result) and any(0 < r[2] < r[1] for r in result)


def test_odd_rows(spark):
    long = "x " * 200_000
    own = " ".join(f"n{i}" for i in range(30))
    rows = [(i, t, lang, s) for i, t, lang, s in edges.ROWS]
    rows += [(30, long, "en", "a"), (None, own + " " + own, "en", "a"), (None, own, "en", "a")]
    rows += [(31, own, "en", "a"), (31, own, "en", "a"), (31, own + " more", "en", "a"), (32, own, "en", "a")]
    rows += [(-5, own.upper() + "\x1c " + own, "en", "a"), (33, "y" * 300_000, "en", "a")]
    result = ordered(found(sd.dedup_words(edges.documents(spark, rows))))
    assert result == ordered(brute_force([(r[0], r[1]) for r in rows]))
    digests = sd.dedup_words(edges.documents(spark, rows), digest=True).select("doc_id", "kept_sha256").collect()
    expected = [(r[0], hashlib.sha256(r[3].encode()).hexdigest()) for r in result]
    assert sorted(map(str, [tuple(d) for d in digests])) == sorted(map(str, expected))
    assert sd.dedup_words(edges.no_documents(spark)).count() == 0


def test_spans_tell_sequences_apart():
    words = sd.Words(pa.array(["a b c d e f g h a b c d e f g h", "b a", None, ""]))
    eight = sd.spans(words.hashes, 8)
    for width in (1, 3, 8, 20):
        h = np.arange(40, dtype=np.uint64)
        assert len(sd.spans(h, width)) == 41 - width
        assert len(set(sd.spans(h, width).tolist())) == 41 - width
    assert eight[0] == eight[8]
    assert words.counts.tolist() == [16, 2, 0, 0]

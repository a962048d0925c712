from collections import Counter, defaultdict
import random

import pytest

from offhours.llm import set_join
from tests.llm.edges import documents, no_documents


def shingles(text, width):
    w = (text or "").encode().lower().split()
    if len(w) < width:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[i : i + width]) for i in range(len(w) - width + 1))


def classes(rows, width, percent):
    """Rows of (number of shingles, least id reachable), by all pairs."""
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in holders[x] if j > i).items():
            if 100 * both >= percent * (len(s) + len(sets[j]) - both):
                parent[find(j)] = find(i)
    least = defaultdict(lambda: None)
    for i, (doc_id, _) in enumerate(rows):
        root = find(i)
        if doc_id is not None and (least[root] is None or doc_id < least[root]):
            least[root] = doc_id
    return [(len(s), least[find(i)]) for i, s in enumerate(sets)]


def compare(frame, width=3, percent=90):
    rows = [(r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect()]
    expected = Counter((i, n, c) for (i, _), (n, c) in zip(rows, classes(rows, width, percent)))
    found = set_join.jaccard_classes(frame, width, percent).collect()
    assert Counter(map(tuple, found)) == expected
    return rows


def near_copies(seed=1, base_words=120, copies=60):
    """Copies of one text with a few words changed, so that links form chains."""
    pick = random.Random(seed)
    base = [f"w{pick.randrange(500)}" for _ in range(base_words)]
    rows = []
    for i in range(copies):
        w = list(base)
        for _ in range(pick.randrange(5)):
            w[pick.randrange(len(w))] = f"new{pick.randrange(40)}"
        rows.append((i * 3 % 101 + 10, " ".join(w), "en", "a"))
    passage = " ".join(f"p{i}" for i in range(30))
    for i in range(40):  # texts that share a passage and are not alike
        own = " ".join(f"v{pick.randrange(400)}" for _ in range(60))
        rows.append((1000 + i, f"{own} {passage}", "en", "b"))
    rows += [(2000 + i, rows[i][1], "en", "c") for i in range(20)]  # exact copies
    return rows


def test_equals_all_pairs(spark):
    compare(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))


@pytest.mark.parametrize("width, percent", [(3, 90), (5, 80)])
def test_near_copies(spark, width, percent):
    compare(documents(spark, near_copies()), width, percent)


def test_long_lists_are_split(spark, monkeypatch):
    monkeypatch.setattr(set_join, "LIST", 8)
    monkeypatch.setattr(set_join, "BLOCK", 4)
    compare(documents(spark, near_copies(2)), 3, 85)


def test_edges(spark):
    compare(documents(spark))
    assert set_join.jaccard_classes(no_documents(spark)).count() == 0


def test_one_of_each(spark):
    docs = documents(spark, [*near_copies(), (6, "solo", "en", None), (6, "solo", "en", None), (7, "", "en", "a"),
                             (None, None, None, None), (8, "solo", "en", "a"), (9, None, "en", "a")])
    kept = set_join.one_of_each(docs, 5, 80)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    expected = Counter()
    for (doc_id, text), (n, least) in zip(rows, classes(rows, 5, 80)):
        if n == 0 or doc_id == least:
            expected[doc_id, text] = 1
    found = Counter((r["doc_id"], r["text"]) for r in kept.collect())
    assert found == expected
    assert set_join.one_of_each(no_documents(spark)).count() == 0

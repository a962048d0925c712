import random

import pyarrow as pa

from offhours.llm.shared import components, sieve, sifted, words
from offhours.llm.text import split_words, word_hashes


def test_components_match_union_find(spark):
    pick = random.Random(3)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(45)]
    edges += [(100 + i, 101 + i) for i in range(40)]  # a long chain
    edges += [(500, 500 + i) for i in range(1, 30)]  # a star
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    found = components(spark.createDataFrame(edges, "a long, b long")).collect()
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert {r["node"]: r["component"] for r in found} == {x: find(x) for x in linked}
    assert len(found) == len(linked)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_sieve_lets_all_members_pass(spark):
    keys = spark.createDataFrame([(i * 7919 - 5000,) for i in range(300)] + [(None,)], "k long")
    all_rows = spark.range(-6000, 3000).selectExpr("id AS k").union(keys)
    found = sifted(all_rows, "k", sieve(keys, "k"), "in")
    passed = {r["k"] for r in found.where("in").collect()}
    assert {i * 7919 - 5000 for i in range(300)} <= passed and None not in passed
    assert found.count() == all_rows.count()
    assert found.where("in").count() < 1000


def test_words_are_cut_at_ascii_white_space_only():
    texts = ["A b\tC\x0bd\x0ce\r\nf", "x\x1cy z\x85w Ä  q", "", None, "  lead", "end  "]
    counts, flat = split_words(pa.array(texts))
    expected = [words(t) for t in texts]
    assert counts.tolist() == [len(w) for w in expected]
    assert [w.encode() for w in flat.to_pylist()] == [w for ws in expected for w in ws]
    counts, hashes = word_hashes(pa.array(["a b a", "b"]))
    assert hashes[0] == hashes[2] != hashes[1] == hashes[3]


def test_a_task_lets_go_what_other_operators_left():
    from offhours.llm import pieces, shared

    for module, left in ((pieces.__name__, 1), (shared.__name__, 0)):
        pieces.encoder.cache_clear()
        pieces.encoder(pieces.MODEL, 0.0, 1, None)
        shared.begin(module)
        assert pieces.encoder.cache_info().currsize == left

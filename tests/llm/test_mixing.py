import heapq
from collections import Counter, defaultdict
from fractions import Fraction

import pytest

from offhours.llm.mixing import interleaved, mixed, op1_mix_sources, schedule, shares, whole_schedule
from tests.llm.edges import documents, no_documents

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("units", [{"a": 1}, {"a": 3, "b": 5, "c": 1}, {"x": 500, "y": 499, "z": 1},
                                   {str(i): 1 + i * i for i in range(20)}])
def test_no_source_is_a_block_off_its_share(units):
    period, served = sum(units.values()), Counter()
    rows = schedule(units)
    assert sorted(r[4] for r in rows) == list(range(period))
    for name, k, release, deadline, slot in sorted(rows, key=lambda r: r[4]):
        assert release <= slot < deadline and k == served[name]
        served[name] += 1
        for other, q in units.items():
            assert abs(served[other] - Fraction(q * (slot + 1), period)) < 1


def test_the_period_repeats_as_a_whole_schedule_does():
    units, turns = {"a": 3, "b": 4, "c": 2}, 4
    period = sum(units.values())
    due = sorted(
        (k * period // q, -(-(k + 1) * period // q), n, k) for n, q in units.items() for k in range(q * turns)
    )
    ready, at, whole = [], 0, {}
    for slot in range(period * turns):  # earliest deadline first over all turns at once
        while at < len(due) and due[at][0] <= slot:
            heapq.heappush(ready, due[at][1:])
            at += 1
        _, name, k = heapq.heappop(ready)
        whole[name, k] = slot
    once = {(n, k): s for n, k, _, _, s in schedule(units)}
    for (n, k), slot in whole.items():
        assert slot == once[n, k % units[n]] + period * (k // units[n])


def test_blocks_of_all_documents(spark):
    rows = op1_mix_sources(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = {r["doc_id"]: max(1, len((r["text"] or "").encode())) for r in docs.collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(sizes)
    by_source, slots = defaultdict(list), defaultdict(set)
    for r in rows:
        by_source[r["source"]].append((r["start"], r["doc_id"], r["block"]))
        slots[r["slot"]].add((r["source"], r["block"]))
        assert r["release"] <= r["slot"] < r["deadline"]
    assert all(len(found) == 1 for found in slots.values())
    for found in by_source.values():  # places follow one another without a gap
        at = 0
        for start, doc_id, block in sorted(found):
            assert start == at and block == at // (1 << 18)
            at += sizes[doc_id]


def test_target_weights_hold_while_sources_last(spark):
    docs = spark.createDataFrame(
        [(i, "x" * 10, "big" if i % 3 else "small") for i in range(3000)], "doc_id long, text string, source string"
    )
    placed = mixed(docs, {"big": 0.5, "small": 0.5}, block_bytes=100, period=10).collect()
    first = [r["source"] for r in sorted(placed, key=lambda r: (r["mix"]["slot"], r["mix"]["start"]))][:1000]
    assert Counter(first)["big"] == 500


def test_seed_and_partitioning(spark):
    docs = documents(spark)

    def order(df, **options):
        return sorted((str(r["doc_id"]), str(r["text"]), tuple(r["mix"])) for r in mixed(df, **options).collect())

    assert order(docs) == order(docs.repartition(7)) != order(docs, seed=9)


def test_edges(spark):
    docs = documents(spark)
    placed = mixed(docs, block_bytes=16, period=12)
    assert placed.count() == docs.count() and placed.columns == [*docs.columns, "mix"]
    assert sorted(map(str, interleaved(docs).collect())) == sorted(map(str, docs.collect()))
    assert mixed(no_documents(spark)).count() == 0
    named = mixed(docs, {"a": 0.9, "nobody": 0.1}, block_bytes=16)
    assert named.count() == docs.count()
    assert shares({"a": 1e-9, "b": 1.0}, 10) == {"a": 1, "b": 10}


THIRD = {f"s{i}": 1 / 7500 for i in range(5000)} | {"s0": 1 / 3}


@pytest.mark.parametrize("weights, blocks", [
    ({"a": 2, "b": 1}, {"a": 8000, "b": 4000}),
    ({"a": 0.1, "b": 0.2, "c": 0.7}, {"a": 1000, "b": 2000, "c": 7000}),
    ({str(i): (1 + i) ** 0.5 for i in range(20)}, {str(i): 400 for i in range(20)}),
    (THIRD, {n: 2000 if n == "s0" else 1 for n in THIRD}),
    ({"a": 1, "b": 1e-300}, {"a": 50, "b": 1}),
])
def test_no_source_is_a_block_off_its_given_weight(weights, blocks):
    total = sum(Fraction(w) for w in weights.values())
    names, rows = whole_schedule(weights, blocks)
    served, last = defaultdict(list), -1
    for i, k, release, deadline, slot in zip(*rows):
        assert release <= slot < deadline and slot > last and k == len(served[names[i]])
        served[names[i]].append(slot)
        last = slot
    assert {n: len(s) for n, s in served.items()} == blocks
    for n, slots in served.items():
        w = Fraction(weights[n]) / total
        for k, slot in enumerate(slots):  # the share is furthest off just before and just behind a block
            assert abs(k - w * slot) < 1 + Fraction(1, 10**6) and abs(k + 1 - w * (slot + 1)) < 1 + Fraction(1, 10**6)


def test_given_weights_hold_over_thousands_of_slots(spark):
    rows = [(i, "x" * 10, "a" if i % 3 else "b") for i in range(15000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    placed = mixed(docs, {"a": 2.0, "b": 1.0}, block_bytes=10).collect()
    served, off = Counter(), 0
    for at, r in enumerate(sorted(placed, key=lambda r: r["mix"]["slot"]), 1):
        assert r["mix"]["slot"] == at - 1
        served[r["source"]] += 1
        off = max(off, abs(served["a"] - Fraction(2 * at, 3)))
    assert at == 15000 and off < 1


def test_documents_longer_than_blocks_and_ranges_of_many(spark):
    rows = [(i, "y" * (1 + i * 37 % 90), "ab"[i % 2]) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixed(docs, block_bytes=16).collect()
    assert len(found) == 400 and all(r["mix"]["block"] == r["mix"]["start"] // 16 for r in found)
    assert len({(r["mix"]["slot"], r["source"]) for r in found}) == len({r["mix"]["slot"] for r in found})

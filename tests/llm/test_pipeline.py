"""Each stage against what it is meant to do, on the rows that its predecessor kept."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offhours.llm.shared import stored
from tests.llm.edges import documents, no_documents
from tests.llm.test_set_join import classes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = [docs]
    for name, stage in corpus_pipeline.STAGES:
        found.append(stored(stage(spark, found[-1], SF), "step"))
    return found


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


def test_all_but_the_last_keep_the_columns(steps):
    assert all(s.dtypes == steps[0].dtypes for s in steps[:-1])


def test_quality_keeps_good_and_drops_bad(spark, steps):
    kept = by_id(steps[1])
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    good, bad = ([x["doc_id"] for x in labels if x["quality"] == q] for q in (1, 0))
    assert sum(i in kept for i in good) > 0.98 * len(good) and sum(i in kept for i in bad) < 0.05 * len(bad)


def test_lines_only_ever_go(steps):
    before, after = by_id(steps[1]), by_id(steps[2])
    assert set(after) <= set(before)
    for i, r in after.items():
        old = iter(before[i]["text"].split("\n"))
        assert not r["text"] or all(line in old for line in r["text"].split("\n"))
        assert r["n_chars"] == len(r["text"])
    for i in set(before) - set(after):  # gone are copies only
        assert any(before[i]["text"].split("\n")[0] in r["text"] for j, r in before.items() if j != i)


def test_one_of_each_class_stays(steps):
    rows = [(i, r["text"]) for i, r in by_id(steps[2]).items()]
    expected = {i for (i, _), (n, least) in zip(rows, classes(rows, 5, 80)) if n == 0 or i == least}
    assert set(by_id(steps[3])) == expected


def test_mixing_keeps_all(steps):
    assert sorted(map(str, steps[3].collect())) == sorted(map(str, steps[4].collect()))


def test_ids_decode_to_the_texts(spark, steps):
    from offhours.llm.pieces import decode

    texts = {i: r["text"] for i, r in by_id(steps[4]).items()}
    assert {r["doc_id"]: r["text"] for r in decode(steps[5]).collect()} == texts
    assert all(r["lossless"] for r in steps[5].collect())


@pytest.mark.parametrize("number", range(5))
def test_edges(spark, number):
    name, stage = corpus_pipeline.STAGES[number]
    for docs in (documents(spark), no_documents(spark)):
        found = stage(spark, docs, SF)
        assert found.count() <= docs.count()
        if number < 4:
            assert found.columns == docs.columns


def test_the_order_of_the_mixture_reaches_the_output(spark, steps):
    from offhours.llm.mixing import BLOCK_BYTES, mixed

    def order(frame):
        return [r["doc_id"] for r in frame.sort("slot", "start").collect()]

    # Stage 4's decision, on the rows that it read; stages 4 and 5 were written and read again.
    expected = order(mixed(steps[3]).select("doc_id", "mix.*"))
    assert order(steps[5].repartition(5)) == expected and len(expected) == steps[3].count()
    assert [r["doc_id"] for r in steps[3].sort("doc_id").collect()] != expected
    # Each source's documents follow one another without a gap, a block of one source a slot.
    source = {i: r["source"] for i, r in by_id(steps[4]).items()}
    size = {i: max(1, len((r["text"] or "").encode())) for i, r in by_id(steps[4]).items()}
    at, owner = {}, {}
    for r in steps[5].sort("slot", "start").collect():
        s = source[r["doc_id"]]
        assert r["start"] == at.get(s, 0)
        assert owner.setdefault(r["slot"], (s, r["start"] // BLOCK_BYTES)) == (s, r["start"] // BLOCK_BYTES)
        at[s] = r["start"] + size[r["doc_id"]]


@pytest.mark.parametrize("order", ["doc_id", "doc_id DESC", "crc32(encode(doc_id, 'utf-8'))"])
def test_the_last_stage_takes_the_order_that_it_is_given(spark, steps, order):
    key = F.expr(order)
    given = steps[3].repartitionByRange(3, key).sortWithinPartitions(key)
    found = corpus_pipeline.encode_pieces(spark, stored(given, "order"), SF).collect()
    rows = {r["slot"]: r["doc_id"] for r in found}
    assert [rows[n] for n in range(len(found))] == [r["doc_id"] for r in steps[3].sort(key).collect()]

import pytest

from offhours.llm.token_counts import MODEL, op7_token_counts, processor, token_counts
from tests.llm.edges import documents, no_documents

ODD = ["", " ", "  a  b ", " lead", "trail ", "▁x▁y", "a\tb\n\n c", "x " * 500, "日本語 😀 é", "<s> hi </s><unk>",
       "A\x00b", "  \n\n  hello", "12 345  6789", "no-spaces" * 300, "▁", " ▁ "]


@pytest.mark.parametrize("frequent", [1 << 18, 4, 0])
def test_equals_the_library(spark, frequent):
    rows = [(i, t, "en", "a") for i, t in enumerate(ODD)]
    rows += [(100 + r["doc_id"], r["text"], "en", "a") for r in
             spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()]
    found = {r["doc_id"]: r for r in token_counts(documents(spark, rows), limit=300, frequent=frequent).collect()}
    for i, text, _, _ in rows:
        n = len(processor(MODEL).encode(text))
        assert (found[i]["n_tokens"], found[i]["n_bytes"]) == (n, len(text.encode())), repr(text[:40])
        assert found[i]["over_limit"] == (n > 300)


def test_registered_query(spark):
    found = op7_token_counts(spark, "/root/testdata/sf0.001")
    assert dict(found.dtypes) == {"doc_id": "bigint", "n_bytes": "bigint", "n_tokens": "bigint", "over_limit": "boolean"}
    assert found.count() == 200
    texts = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()
    found = {r["doc_id"]: r["n_tokens"] for r in op7_token_counts(spark, "/root/testdata/sf0.01").collect()}
    assert found == {i: len(processor(MODEL).encode(t or "")) for i, t in texts}


def test_long_pre_tokens_are_not_broadcast(spark):
    rows = [(i, f"{i}" * 40_000 + " a a a", "en", "a") for i in range(20)]
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts(documents(spark, rows)).collect()}
    assert found == {i: len(processor(MODEL).encode(t)) for i, t, _, _ in rows}


def test_edges(spark):
    docs = documents(spark)
    expected = sorted(
        (str(r["doc_id"]), len((r["text"] or "").encode()), len(processor(MODEL).encode(r["text"] or "")))
        for r in docs.collect()
    )
    found = token_counts(docs).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in found) == expected
    assert token_counts(no_documents(spark)).count() == 0

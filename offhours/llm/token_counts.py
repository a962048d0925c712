"""Token counts without token ids: each distinct pre-token is counted once.

A BPE vocabulary whose pieces hold the space mark only at their beginning never
merges across the start of a run of spaces, so a text's token count is the sum
over its pre-tokens (a run of spaces with the word behind it). ``piece_counts``
runs the library once per distinct pre-token of the whole corpus; documents hold
pre-token frequencies only, and are joined to the counts.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offhours.llm.shared import batches, column, stored, table

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
# What is broadcast: so many pre-tokens at most, none longer than this (16 MB in all).
FREQUENT, LONGEST = 1 << 18, 64
_RUN = re.compile(r" +[^ ]*")


@lru_cache(maxsize=4)
def processor(model: str):
    """The library's tokenizer, loaded once per Python worker."""
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))


def pre_tokens(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """(pre-tokens per text, all pre-tokens in order), each without its first space.

    The library sets a space before each non-empty text and takes U+2581 for a
    space. Texts with single spaces between words are split at them; the others
    need their runs of spaces kept together.
    """
    texts = pc.replace_substring(pc.fill_null(texts, ""), "▁", " ")
    odd = pc.or_(
        pc.or_(pc.match_substring(texts, "  "), pc.starts_with(texts, " ")),
        pc.or_(pc.ends_with(texts, " "), pc.equal(texts, "")),
    ).to_numpy(zero_copy_only=False)
    if not odd.any():
        lists = pc.split_pattern(texts, " ")
    else:
        some = texts.to_pylist()
        lists = pa.array(
            [
                ([run[1:] for run in _RUN.findall(" " + t)] if t else []) if is_odd else t.split(" ")
                for t, is_odd in zip(some, odd)
            ],
            pa.list_(pa.string()),
        )
    return np.diff(lists.offsets.to_numpy()), lists.flatten()


def count_pieces(tokens: list[str], model: str) -> np.ndarray:
    """Pieces of each pre-token; the one of a single space has no text left but is a piece."""
    encoded = processor(model).encode(tokens, num_threads=1)
    return np.array([len(ids) if t else 1 for t, ids in zip(tokens, encoded)], np.int64)


def _frequencies(batch: pa.RecordBatch) -> pa.RecordBatch:
    counted = pre_tokens(batch.column(0))[1].value_counts()
    return pa.RecordBatch.from_arrays(
        [counted.field(0).cast(pa.string()), counted.field(1)], ["pre_token", "n"]
    )


def piece_counts(docs: DataFrame, model: str = MODEL, text: str = "text") -> DataFrame:
    """Every distinct pre-token of the corpus with its frequency ``n`` and its ``pieces``."""

    def count(batch):
        pieces = count_pieces(batch.column(0).to_pylist(), model)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(pieces)], ["pre_token", "n", "pieces"]
        )

    seen = docs.select(column(docs, text).alias("text")).mapInArrow(
        batches(_frequencies, rows=10_000), "pre_token string, n long"
    )
    return stored(
        seen.groupBy("pre_token")
        .agg(F.sum("n").alias("n"))
        .mapInArrow(batches(count), "pre_token string, n long, pieces long"),
        "pre-tokens",
    )


def _most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """Pre-tokens above a frequency that are not too long, at most ``most`` of them."""
    counts = counts.where(F.octet_length("pre_token") <= LONGEST)
    level = F.floor(F.log2("n") * 8).cast("int")
    found = counts.groupBy(level.alias("level")).count().orderBy(F.desc("level")).collect()
    cut, total = None, 0
    for row in found:  # at most 8 * 63 levels
        total += row["count"]
        if total > most:
            break
        cut = row["level"]
    return counts.where(level >= cut) if cut is not None else counts.limit(0)


def token_counts(
    docs: DataFrame,
    model: str = MODEL,
    limit: int = LIMIT,
    id_column: str = "doc_id",
    text: str = "text",
    frequent: int = FREQUENT,
) -> DataFrame:
    """Tokens per document: ``doc_id``, ``n_bytes``, ``n_tokens``, ``over_limit``.

    Counts of the most frequent short pre-tokens (``frequent`` at most, up to 64 bytes each: the
    bound of what is broadcast) are looked up where the documents are; all other
    pre-tokens are joined to their counts by a shuffle. Rows are told apart by id
    and text, and counted, so repeated or null ids stay separate rows, in whatever order
    rows come when a task runs again. A null or empty text has 0 bytes and 0 tokens; an
    empty table gives an empty result. Only the two named columns are read, so other
    columns cannot clash.
    """
    spark = docs.sparkSession
    counts = piece_counts(docs, model, text)
    known = spark.sparkContext.broadcast(
        _most_frequent(counts, frequent).select("pre_token", "pieces").toArrow()
    )

    def look_up(batch, pieces_of):
        n, tokens = pre_tokens(batch.column(3))
        rows = np.repeat(np.arange(batch.num_rows), n)
        coded = tokens.dictionary_encode()
        each = np.array([pieces_of(t, -1) for t in coded.dictionary.to_pylist()], np.int64)
        each = each[coded.indices.to_numpy()] if len(tokens) else each
        rare = each < 0
        each[rare] = 0
        ends = np.concatenate([[0], np.cumsum(each)])[np.concatenate([[0], np.cumsum(n)])]
        left = (
            pa.table({"row": rows[rare], "pre_token": tokens.filter(pa.array(rare))})
            .group_by(["row", "pre_token"])
            .aggregate([([], "count_all")])
        )
        sizes = pc.binary_length(pc.fill_null(batch.column(3), "").cast(pa.binary()))
        some, more = batch.num_rows, left.num_rows
        of = pa.concat_arrays([pa.array(np.arange(some)), left.column("row").combine_chunks()])
        # Only a document's own row bears its id; the others are told apart by hashes.
        ids = pa.concat_arrays([batch.column(0), pa.nulls(more, batch.column(0).type)])
        return pa.RecordBatch.from_arrays(
            [
                ids,
                *[batch.column(i).take(of) for i in (1, 2)],
                pa.concat_arrays([sizes.cast(pa.int64()), pa.nulls(more, pa.int64())]),
                pa.concat_arrays([pa.array(np.diff(ends)), left.column("count_all").combine_chunks()]),
                pa.concat_arrays([pa.nulls(some, pa.string()), left.column("pre_token").combine_chunks()]),
            ],
            ["id", "h1", "h2", "n_bytes", "n", "pre_token"],
        )

    def run(it):
        # One dictionary for all batches of a task.
        names, numbers = (known.value.column(c).to_pylist() for c in ("pre_token", "pieces"))
        pieces_of = dict(zip(names, numbers)).get
        return batches(lambda batch: look_up(batch, pieces_of))(it)

    kind = dict(docs.dtypes)[id_column]
    # Rows without a pre-token are the documents; what they need is in place.
    text = column(docs, text)
    parts = docs.select(
        column(docs, id_column).alias("id"),
        F.xxhash64(column(docs, id_column), text).alias("h1"),
        F.hash(column(docs, id_column), text).alias("h2"),
        text.alias("text"),
    ).mapInArrow(run, f"id {kind}, h1 long, h2 int, n_bytes long, n long, pre_token string")
    # A document's own row joins nothing: its key is no pre-token and only has to be spread.
    own = F.concat(F.lit("  ▁"), F.monotonically_increasing_id().cast("string"))
    joined = parts.withColumn("key", F.coalesce("pre_token", own)).join(
        counts.select(F.col("pre_token").alias("key"), "pieces"), "key", "left"
    )
    tokens = F.sum(F.col("n") * F.coalesce("pieces", F.lit(1)))
    # Rows with one id and text have the same count: the sum over them all is shared out.
    each = joined.groupBy("h1", "h2").agg(
        F.max("id").alias("id"), F.max("n_bytes").alias("n_bytes"), F.count("n_bytes").alias("copies"), tokens.alias("all")
    )
    counted = each.select(
        F.col("id").alias(id_column), "n_bytes", F.expr("all div copies").alias("n_tokens"), "copies"
    )
    rows = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies", "copy")
    return rows.withColumn("over_limit", F.col("n_tokens") > limit)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))

"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL.

Follow-the-regularised-leader (McMahan et al., 2013) keeps two numbers per
feature and leaves weights at exactly zero until their gradients outweigh the
L1 term, so the model is a sparse vector of fixed length. A document's score is
the logistic of a sparse dot product.

N-grams are taken over three readings of each word: the word itself, its shape
(runs of letters, digits and marks), and whether it repeats the word before.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offhours.llm.shared import batches, column, spare, stored, table
from offhours.llm.text import mixed, paired

BITS = 18
SAMPLE = 8_000
EPOCHS = 3
SEED = 6
THRESHOLD = 0.3
FOLDS = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.0
SCALE = 8.0

# Shapes, applied one after the other (RE2): capitals, small letters, digits.
_SHAPES = [(r"\p{Lu}+", "A"), (r"\p{L}+", "a"), (r"\p{Nd}+", "0")]


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    """Whether a document is kept from training; a null id counts as an empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == 0


def features(texts: pa.Array, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(features per text, feature numbers in order). A text without words has none."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    flat = lists.flatten()
    real = pc.not_equal(flat, "")
    kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    bounds = kept[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
    coded = flat.filter(real).dictionary_encode()
    names, at = coded.dictionary, coded.indices.to_numpy()
    if not len(at):
        return np.zeros(len(texts), np.int64), np.empty(0, np.int64)
    shapes = names
    for pattern, mark in _SHAPES:
        shapes = pc.replace_substring_regex(shapes, pattern, mark)

    def hashed(values):
        return pd.util.hash_array(values.to_numpy(zero_copy_only=False), categorize=False)

    word = hashed(pc.utf8_lower(names))[at]
    shape = hashed(shapes)[at]
    # The word before, 0 at the beginning of a text.
    starts = bounds[:-1][bounds[:-1] < bounds[1:]]

    def before(a):
        out = np.empty_like(a)
        out[1:], out[0] = a[:-1], 0
        out[starts] = 0
        return out

    last = before(word)
    again = np.where(last == word, np.uint64(11), np.uint64(12))
    found = np.stack(
        [
            mixed(word + np.uint64(1)),
            paired(last, word),
            mixed(shape + np.uint64(3)),
            paired(before(shape) + np.uint64(4), shape),
            mixed(again),
        ],
        axis=1,
    ) & np.uint64((1 << bits) - 1)
    return np.diff(bounds) * found.shape[1], found.astype(np.int64).ravel()


def _rows(counts: np.ndarray, numbers: np.ndarray):
    """Each text's distinct features with their weights: SCALE times their share."""
    ends = np.cumsum(counts)
    for start, end in zip(ends - counts, ends):
        index, n = np.unique(numbers[start:end], return_counts=True)
        yield index.astype(np.int32), (n * (SCALE * 5 / max(1, end - start))).astype(np.float32)


def train(texts: pa.Array, labels: np.ndarray, bits: int, epochs: int, seed: int) -> np.ndarray:
    """Weights of the features and, last, the constant: FTRL over shuffled examples."""
    size = (1 << bits) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    rows = [
        row
        for at in range(0, len(texts), 256)  # the features of all texts at once would be large
        for row in _rows(*features(texts.slice(at, 256), bits))
    ]
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            index, x = rows[i]
            index, x = np.append(index, size - 1), np.append(x, 1.0)
            zi, ni = z[index], n[index]
            wi = np.where(
                np.abs(zi) <= L1, 0.0, (np.sign(zi) * L1 - zi) / ((BETA + np.sqrt(ni)) / ALPHA + L2)
            )
            p = 1.0 / (1.0 + np.exp(-np.clip(wi @ x, -35, 35)))
            g = (p - labels[i]) * x
            z[index] = zi + g - (np.sqrt(ni + g * g) - np.sqrt(ni)) / ALPHA * wi
            n[index] = ni + g * g
    busy = np.abs(z) > L1
    w[busy] = (np.sign(z[busy]) * L1 - z[busy]) / ((BETA + np.sqrt(n[busy])) / ALPHA + L2)
    return w


def scores(texts: pa.Array, weights: np.ndarray, bits: int) -> np.ndarray:
    counts, numbers = features(texts, bits)
    sums = np.concatenate([[0.0], np.cumsum(weights[numbers])])[np.concatenate([[0], np.cumsum(counts)])]
    dots = np.diff(sums) * (SCALE * 5) / np.maximum(counts, 1)
    return 1.0 / (1.0 + np.exp(-np.clip(dots + weights[-1], -35, 35)))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    sample: int = SAMPLE,
    bits: int = BITS,
    epochs: int = EPOCHS,
    seed: int = SEED,
    folds: int = FOLDS,
) -> np.ndarray:
    """Train on labelled documents outside the held-out fold; at most ``sample`` of them.

    The sample is the first ids in a seeded hash order, so it does not depend on
    partitioning; it bounds what one task trains on and what is broadcast (ids).
    Of several labels of an id the largest counts, of several texts of an id one;
    null ids, labels and texts teach nothing. Without examples all weights are 0,
    so every score is 0.5.
    """
    wanted = (
        labels.select(column(labels, "doc_id").alias("id"), column(labels, label).alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id"), folds))
        .groupBy("id")
        .agg(F.max("label").cast("double").alias("label"))
        .orderBy(F.xxhash64(F.col("id").cast("string"), F.lit(seed)), "id")
        .limit(sample)
    )
    examples = (
        docs.select(column(docs, "doc_id").alias("id"), column(docs, "text").alias("text"))
        .where(F.col("text").isNotNull())
        .join(F.broadcast(wanted), "id")
        .groupBy("id")
        .agg(F.max("label").alias("label"), F.min("text").alias("text"))
    )

    def learn(frame: pa.Table) -> pa.Table:
        frame = frame.sort_by("id")
        weights = train(
            frame.column("text").combine_chunks(), frame.column("label").to_numpy(), bits, epochs, seed
        )
        return pa.table({"weights": pa.array([weights.tobytes()], pa.binary())})

    model = stored(
        examples.groupBy(F.lit(0).alias("one")).applyInArrow(learn, "weights binary"), "quality-model"
    ).collect()
    return np.frombuffer(model[0]["weights"]) if model else np.zeros((1 << bits) + 1)


def score(docs: DataFrame, weights: np.ndarray, out: str = "score", bits: int = BITS) -> DataFrame:
    """All rows and columns of ``docs`` with the probability of label 1 as ``out``.

    The model has a fixed size and is broadcast. Null and empty texts, and those
    without words, get the score of the constant alone. ``out`` must be a new name.
    """
    model = docs.sparkSession.sparkContext.broadcast(weights)
    rest = F.struct(*[column(docs, c).alias(c) for c in docs.columns if c != "text"])
    rows = docs.select(rest.alias("doc"), column(docs, "text").alias("text"))

    def run(batch):
        found = scores(batch.column(1), model.value, bits)
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], ["doc", "text", "score"])

    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType())])
    scored = rows.mapInArrow(batches(run), schema)
    own = [F.col("text") if c == "text" else F.col("doc").getField(c).alias(c) for c in docs.columns]
    return scored.select(*own, F.col("score").alias(out))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with their own columns."""
    name = spare(docs, "score")
    scored = score(docs, fit(docs, labels), name)
    return scored.where(F.col(name) >= threshold).drop(name)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )

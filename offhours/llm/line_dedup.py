"""Removal of repeated passages of several lines, cut where their content says.

A rolling hash over the hashes of two neighbouring lines has its peaks where a
passage is cut, so a passage is cut alike wherever it stands and an inserted line
moves boundaries only near it. Chunks of two lines or more that occur again anywhere in the
corpus are removed but for their first place, once grouping by their text has
shown that their bytes are equal.

Short passages seldom hold a whole chunk, and long ones reach beyond their chunks.
So pairs of neighbouring lines are keyed too, blank lines between them aside: all
pairs of a repeated run of lines stand elsewhere before, and the lines of such pairs
together are the runs in full length, from two lines on.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offhours.llm.shared import SIEVE_BITS, batches, column, sieve, sifted, stored, table
from offhours.llm.text import mixed, paired

_ALL = (1 << 64) - 1
# Numbers of pairs are those of their first lines, above all numbers of chunks.
_PAIRS = 1 << 30
# Many more keys repeat than with chunks alone.
_PAIR_BITS = 24
CUT = "n_lines int, n_removed int, removed array<struct<first:int,last:int>>"


class Chunks:
    """The chunks of a batch of texts: rows, numbers, line counts, hashes, places."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, "\n")
        lines = lists.flatten()
        self.bounds = lists.offsets.to_numpy().astype(np.int64)
        self.bounds = self.bounds - self.bounds[0]
        total = len(lines)
        coded = lines.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False)
        at = coded.indices.to_numpy()
        line = pd.util.hash_array(names, categorize=False)[at] if total else np.empty(0, np.uint64)
        words = pc.match_substring_regex(coded.dictionary, r"\S").to_numpy(zero_copy_only=False)
        first = np.zeros(total, bool)
        first[self.bounds[:-1]] = True
        last = np.zeros(total, bool)
        last[self.bounds[1:] - 1] = True
        # Rolling hash of each line and the one before it; a boundary behind every line
        # where it is larger than at both neighbours. Two never follow one another.
        rolling = paired(np.where(first, np.uint64(0), np.roll(line, 1)), line)
        before = np.where(first, np.uint64(_ALL), np.roll(rolling, 1))
        behind = np.where(last, np.uint64(0), np.roll(rolling, -1))
        ends = ((rolling > before) & (rolling >= behind)) | last
        starts = np.flatnonzero(np.concatenate([[True], ends[:-1]])) if total else np.empty(0, int)
        stops = np.flatnonzero(ends) + 1
        self.lines = stops - starts
        place = np.arange(total) - np.repeat(starts, self.lines)
        summands = mixed(line + mixed(place.astype(np.uint64) + np.uint64(1)))
        sums = np.add.reduceat(summands, starts) if total else summands
        self.hashes = mixed(sums + self.lines.astype(np.uint64)).view(np.int64)
        filled = np.maximum.reduceat(words[at], starts) if total else np.empty(0, bool)
        self.several = (self.lines > 1) & filled
        self.rows = np.searchsorted(self.bounds, starts, side="right") - 1
        first_chunk = np.searchsorted(self.rows, np.arange(len(texts)))
        self.numbers = np.arange(len(starts)) - first_chunk[self.rows]
        self.starts, self.stops = starts, stops
        self._lists = lists
        # Neighbouring lines that are not blank, by the numbers of both.
        solid = np.flatnonzero(words[at]) if total else np.empty(0, int)
        row = np.searchsorted(self.bounds, solid, side="right") - 1
        near = row[:-1] == row[1:]
        self.upper, self.lower = solid[:-1][near], solid[1:][near]
        self.pair_rows = row[:-1][near]
        self.pair_numbers = _PAIRS + self.upper - self.bounds[self.pair_rows]
        self.pair_hashes = paired(line[self.upper], line[self.lower]).view(np.int64)

    def texts(self, which: np.ndarray) -> pa.Array:
        """Text of the given chunks."""
        lines = self._lists.flatten()
        offsets = np.concatenate([[0], np.cumsum(self.lines[which])]).astype(np.int32)
        taken = np.repeat(self.starts[which] - offsets[:-1], self.lines[which]) + np.arange(offsets[-1])
        grouped = pa.ListArray.from_arrays(pa.array(offsets), lines.take(pa.array(taken)))
        return pc.binary_join(grouped, "\n")

    def pair_texts(self) -> pa.Array:
        """Text of all pairs of lines."""
        lines = self._lists.flatten()
        return pc.binary_join_element_wise(
            lines.take(pa.array(self.upper)), lines.take(pa.array(self.lower)), "\n"
        )


def _keyed(docs: DataFrame) -> DataFrame:
    """Every row: its text, the other columns as a struct, and what tells documents apart."""
    return docs.select(
        F.struct(*[column(docs, c) for c in docs.columns if c != "text"]).alias("doc"),
        column(docs, "doc_id").alias("id"),
        F.xxhash64(column(docs, "text"), column(docs, "doc_id")).alias("key"),
        column(docs, "text").alias("text"),
    )


def _found(rows: DataFrame, with_text: bool, grow: bool) -> DataFrame:
    """Chunks of several lines: ``id``, ``key``, ``number``, ``hash``, or ``hash`` and ``chunk``.

    With ``grow`` the pairs of neighbouring lines, too.
    """
    if with_text:

        def run(batch):
            chunks = Chunks(batch.column(0))
            which = np.flatnonzero(chunks.several)
            hashes, texts = chunks.hashes[which], chunks.texts(which)
            if grow:
                hashes = np.concatenate([hashes, chunks.pair_hashes])
                texts = pa.concat_arrays([texts, chunks.pair_texts()])
            return pa.RecordBatch.from_arrays([pa.array(hashes), texts], ["hash", "chunk"])

        return rows.select("text").mapInArrow(batches(run), "hash long, chunk string")

    def run(batch):
        chunks = Chunks(batch.column(2))
        which = np.flatnonzero(chunks.several)
        row, numbers, hashes = chunks.rows[which], chunks.numbers[which], chunks.hashes[which]
        if grow:
            row = np.concatenate([row, chunks.pair_rows])
            numbers = np.concatenate([numbers, chunks.pair_numbers])
            hashes = np.concatenate([hashes, chunks.pair_hashes])
        row = pa.array(row)
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(row),
                batch.column(1).take(row),
                pa.array(numbers.astype(np.int32)),
                pa.array(hashes),
            ],
            ["id", "key", "number", "hash"],
        )

    kind = dict(rows.dtypes)["id"]
    return rows.select("id", "key", "text").mapInArrow(
        batches(run), f"id {kind}, key long, number int, hash long"
    )


def repeated_chunks(docs: DataFrame, grow: bool = False) -> DataFrame:
    """``hash`` and ``copies`` of chunks that occur twice or more, byte by byte.

    A hash that two different texts share is left out: neither is ever removed.
    With ``grow`` also those of pairs of neighbouring lines; as these hold all lines
    twice, only the texts of hashes that occur again are moved.
    """
    rows = _keyed(docs)
    alike = _found(rows, True, grow)
    if grow:
        again = stored(
            _found(rows, False, grow).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).select("hash"),
            "again",
        )
        likely = sifted(alike, "hash", sieve(again, "hash", _PAIR_BITS), "likely", _PAIR_BITS)
        # Equal texts combine map-side; what passed by chance has no second place.
        alike = likely.where("likely").select("hash", "chunk")
    alike = alike.groupBy("hash", "chunk").agg(F.count(F.lit(1)).alias("n"))
    return (
        alike.groupBy("hash")
        .agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("copies"))
        .where((F.col("texts") == 1) & (F.col("copies") > 1))
        .select("hash", "copies")
    )


def dedup_lines(docs: DataFrame, grow: bool = False) -> DataFrame:
    """``docs`` without repeated chunks; adds the struct ``cut`` with what was removed.

    A chunk's first place, by document id, then text, then position, keeps it.
    ``cut`` has ``n_lines``, ``n_removed`` and ``removed`` (pairs of first and last
    line, from 0) and replaces a column of that name; ``n_chars``, if there, is set
    to the new length. All rows stay, also those left without text. Null and
    empty texts have no chunks and stay as they are. Rows that agree in id and
    text are one document: they keep and lose the same lines. Null ids come first.

    With ``grow`` every run of two lines or more goes, in full length, that stands
    elsewhere before, whether or not it holds a chunk; blank lines neither count nor
    tell runs apart, and go with the lines around them. The first place of each line
    always stays. ``removed`` then has whole runs.
    """
    docs = docs.drop("cut")
    rows = _keyed(docs)
    repeated = stored(repeated_chunks(docs, grow), "chunks")
    bits = _PAIR_BITS if grow else SIEVE_BITS
    found = _found(rows, False, grow)
    seen = sifted(found, "hash", sieve(repeated, "hash", bits), "likely", bits).where("likely")
    places = stored(
        seen.join(repeated.select("hash"), "hash").select("hash", "id", "key", "number"), "places"
    )
    # One row per hash; equal places combine map-side first, so a chunk that a third
    # of all documents hold is no heavy group. Written apart, so that Spark may split
    # the places of such a chunk in the join.
    firsts = stored(
        places.groupBy("hash").agg(F.min(F.struct("id", "key", "number")).alias("first")), "firsts"
    )
    copies = places.join(firsts, "hash").where(F.struct("id", "key", "number") != F.col("first"))
    cuts = stored(
        copies.select("id", "key", "number").distinct()
        .groupBy("id", "key").agg(F.array_sort(F.collect_list("number")).alias("numbers")),
        "cuts",
    )
    parted = sifted(rows, "key", sieve(cuts, "key"), "likely")
    none = F.lit(None).cast("array<int>").alias("numbers")
    untouched = parted.where(~F.col("likely")).select("doc", "text", none)
    touched = parted.where("likely").alias("d").join(
        cuts.alias("c"),
        F.col("d.id").eqNullSafe(F.col("c.id")) & (F.col("d.key") == F.col("c.key")),
        "left",
    ).select("d.doc", "d.text", "c.numbers")
    schema = T.StructType([*untouched.select("doc", "text").schema.fields, T.StructField("cut", T.StructType.fromDDL(CUT))])
    cleaned = untouched.union(touched).mapInArrow(batches(_cutter(grow)), schema)

    def final(name):
        if name == "text":
            return F.col("text")
        if name == "n_chars":
            kind = dict(docs.dtypes)[name]
            length = F.length("text").cast(kind)
            return F.when(F.col("cut.n_removed") > 0, length).otherwise(F.col("doc.n_chars")).alias(name)
        return F.col("doc").getField(name).alias(name)

    return cleaned.select(*[final(n) for n in docs.columns], "cut")


def _runs(lines: set[int]) -> list[tuple[int, int]]:
    """First and last of each run of neighbouring numbers."""
    runs = []
    for n in sorted(lines):
        if runs and runs[-1][1] == n - 1:
            runs[-1] = (runs[-1][0], n)
        else:
            runs.append((n, n))
    return runs


def _cutter(grow: bool):
    pair = pa.struct([("first", pa.int32()), ("last", pa.int32())])
    kind = pa.struct([("n_lines", pa.int32()), ("n_removed", pa.int32()), ("removed", pa.list_(pair))])

    def run(batch):
        chunks = Chunks(batch.column(1))
        of = np.searchsorted(chunks.rows, np.arange(batch.num_rows + 1))
        pairs_of = np.searchsorted(chunks.pair_rows, np.arange(batch.num_rows + 1))
        n_lines = np.diff(chunks.bounds)
        texts, cuts = batch.column(1).to_pylist(), []
        for i, numbers in enumerate(batch.column(2).to_pylist()):
            removed = []
            if numbers:
                start = chunks.bounds[i]
                removed = [
                    (int(chunks.starts[of[i] + n] - start), int(chunks.stops[of[i] + n] - 1 - start))
                    for n in numbers
                    if n < _PAIRS
                ]
                pairs = np.array([n for n in numbers if n >= _PAIRS], np.int64)
                if len(pairs):
                    own = slice(pairs_of[i], pairs_of[i + 1])
                    at = np.searchsorted(chunks.pair_numbers[own], pairs)
                    removed += zip(
                        (chunks.upper[own][at] - start).tolist(), (chunks.lower[own][at] - start).tolist()
                    )
                gone = {line for a, b in removed for line in range(a, b + 1)}
                if grow:
                    removed = _runs(gone)
                lines = texts[i].split("\n")
                texts[i] = "\n".join(line for n, line in enumerate(lines) if n not in gone)
            cuts.append(
                {
                    "n_lines": int(n_lines[i]) if texts[i] is not None else 0,
                    "n_removed": sum(b - a + 1 for a, b in removed),
                    "removed": [{"first": a, "last": b} for a, b in removed],
                }
            )
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string()), pa.array(cuts, kind)], ["doc", "text", "cut"]
        )

    return run


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(docs, grow=True).select("doc_id", "text", "cut.*")

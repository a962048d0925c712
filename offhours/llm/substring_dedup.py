"""Removal of repeated word sequences, found by anchors at the places of a difference cover.

A match of 20 words is found without hashing every window of 20. Of each document
only the places whose number modulo 13 lies in {0, 1, 3, 9} carry an anchor, a hash
of the 8 words from there. Every difference modulo 13 is one between two members of
that set. So wherever two equal windows of 20 words start, there is a shift below 13
that brings both starts to places with an anchor, and 12 + 8 words lie inside of
the match: any long match shares an aligned anchor.

Anchors that occur once in the corpus rule their surroundings out. The others are
extended to the windows of 20 words around them, and the earliest document of each
such window is found by grouping. A document learns which of its windows are first
there, rather than which are not: a window that very many documents hold
is then one row, and no pairs of places are ever formed.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offhours.llm.shared import batches, column, discard, stored, table
from offhours.llm.text import mixed, paired

WINDOW = 20
# A perfect difference set: 4 * 3 differences are all of 1 to 12 modulo 13.
PERIOD = 13
COVER = (0, 1, 3, 9)
ANCHOR = WINDOW - PERIOD + 1

_CANDIDATES = "first array<int>, again array<int>"
# Larger batches share more words.
_BATCH = 4 << 20


class Words:
    """The words of a batch of texts as two independent 64-bit hashes each, in order."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        offsets = lists.offsets.to_numpy()
        flat = lists.flatten()
        real = pc.not_equal(flat, "")
        kept = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
        self.bounds = kept[offsets - offsets[0]]
        self.words = flat.filter(real)
        self.counts = np.diff(self.bounds)
        coded = self.words.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False)
        self._at = coded.indices.to_numpy()
        self._names = names
        self.hashes = self._hashed("0123456789123456")

    def _hashed(self, key: str) -> np.ndarray:
        if not len(self._names):
            return np.empty(0, np.uint64)
        return pd.util.hash_array(self._names, hash_key=key, categorize=False)[self._at]

    def second(self) -> np.ndarray:
        return self._hashed("another-16-bytes")

    def starts(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(text, place in all words) of every run of ``width`` words inside one text."""
        per = np.maximum(self.counts - width + 1, 0)
        row = np.repeat(np.arange(len(per)), per)
        place = np.arange(per.sum()) - np.repeat(np.cumsum(per) - per, per)
        return row, self.bounds[:-1][row] + place

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, place, hash) of the anchors in texts that hold a window."""
        row, at = self.starts(ANCHOR)
        inside = (at - self.bounds[:-1][row]) % PERIOD
        chosen = np.isin(inside, COVER) & (self.counts[row] >= WINDOW)
        row, at = row[chosen], at[chosen]
        return row, at, spans(self.hashes, ANCHOR)[at] if len(at) else np.empty(0, np.uint64)


def spans(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each place on, built by doubling."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    power, done, found = hashes, 0, None
    bit = 1
    while bit <= width:
        if width & bit:
            part = power[done : done + len(hashes) - width + 1]
            found = mixed(part + np.uint64(bit)) if found is None else paired(found, part)
            done += bit
        if bit * 2 <= width:
            power = paired(power[:-bit], power[bit:])
        bit *= 2
    return found


def _doubled(row: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of keyed entries: (whether it is the first of its key in its row, whether the key is alone)."""
    order = np.lexsort((np.arange(len(row)), hashes, row))
    r, h = row[order], hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (r[1:] != r[:-1]) | (h[1:] != h[:-1])
    last = np.ones(len(order), bool)
    last[:-1] = new[1:]
    first, alone = np.empty(len(order), bool), np.empty(len(order), bool)
    first[order], alone[order] = new, new & last
    return first, alone


def _anchor_rows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row per document and anchor; anchors that one document repeats need none."""
    row, _, hashes = Words(batch.column(1)).anchors()
    first, _ = _doubled(row, hashes)
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(row[first])), pa.array(hashes[first].view(np.int64))],
        ["id", "anchor"],
    )


def _member(values: np.ndarray, rows: np.ndarray, lists: pa.Array) -> np.ndarray:
    """Whether each value is in the list of its row."""
    known = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    of = np.repeat(np.arange(len(lists)), _lengths(lists))
    where = np.concatenate([rows, of])
    what = np.concatenate([values, known])
    asked = np.concatenate([np.ones(len(rows), bool), np.zeros(len(of), bool)])
    order = np.lexsort((asked, what, where))
    w, x, a = where[order], what[order], asked[order]
    # Known values stand ahead of equal ones that are asked for.
    new = np.ones(len(order), bool)
    new[1:] = (w[1:] != w[:-1]) | (x[1:] != x[:-1])
    group = np.cumsum(new) - 1
    found = np.zeros(len(order), bool)
    found[order] = ~a[np.flatnonzero(new)][group] if len(order) else found
    return found[: len(rows)]


def _lengths(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)


def _lists(values: pa.Array, rows: np.ndarray, n: int) -> pa.Array:
    """Values of rising rows as one list per row."""
    offsets = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def _candidates(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Windows around anchors that are not alone: first ones in their document, and later ones."""
    n = batch.num_rows
    words = Words(batch.column(1))
    row, at, hashes = words.anchors()
    _, alone = _doubled(row, hashes)
    alone &= _member(hashes, row, batch.column(2))
    # Windows that hold an anchor which occurs again.
    total = len(words.hashes)
    reach = np.zeros(total + 1, np.int64)
    shared = at[~alone]
    np.add.at(reach, np.maximum(shared - (PERIOD - 1), words.bounds[:-1][row[~alone]]), 1)
    np.add.at(reach, shared + 1, -1)
    w_row, w_at = words.starts(WINDOW)
    likely = np.cumsum(reach)[w_at] > 0
    w_row, w_at = w_row[likely], w_at[likely]
    place = (w_at - words.bounds[:-1][w_row]).astype(np.int32)
    if len(w_at):
        a, b = spans(words.hashes, WINDOW)[w_at], spans(words.second(), WINDOW)[w_at]
    else:
        a = b = np.empty(0, np.uint64)
    first, _ = _doubled(w_row, paired(a, b))
    return pa.RecordBatch.from_arrays(
        [
            batch.column(0),
            batch.column(1),
            _lists(pa.array(place[first]), w_row[first], n),
            _lists(pa.array(place[~first]), w_row[~first], n),
        ],
        ["id", "text", "first", "again"],
    )


def _places(words: Words, starts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, place in all words) of lists of places in texts."""
    row = np.repeat(np.arange(len(starts)), _lengths(starts))
    return row, words.bounds[:-1][row] + starts.flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _windows(batch: pa.RecordBatch) -> pa.RecordBatch | None:
    """A row per document and candidate; columns id, text, first."""
    words = Words(batch.column(1))
    row, at = _places(words, batch.column(2))
    if not len(at):
        return None
    a, b = spans(words.hashes, WINDOW)[at], spans(words.second(), WINDOW)[at]
    return pa.RecordBatch.from_arrays(
        [batch.column(0).take(pa.array(row)), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
        ["id", "a", "b"],
    )


def _cleaned(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Texts without the words of windows that start earlier; columns id, text, first, again, kept."""
    n = batch.num_rows
    words = Words(batch.column(1))
    first, again = batch.column(2), batch.column(3)
    row, at = _places(words, first)
    key = spans(words.hashes, WINDOW)[at] if len(at) else np.empty(0, np.uint64)
    own = pc.is_null(batch.column(0)).to_numpy(zero_copy_only=False)[row] | _member(key, row, batch.column(4))
    gone = np.concatenate([at[~own], _places(words, again)[1]])
    depth = np.zeros(len(words.hashes) + 1, np.int64)
    np.add.at(depth, gone, 1)
    np.add.at(depth, gone + WINDOW, -1)
    covered = np.cumsum(depth)[:-1] > 0
    sums = np.concatenate([[0], np.cumsum(covered)])
    removed = sums[words.bounds[1:]] - sums[words.bounds[:-1]]
    left = words.words.filter(pa.array(~covered))
    ends = words.bounds - sums[words.bounds]
    kept = pc.binary_join(pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), left), " ")
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(words.counts), pa.array(removed), kept],
        ["id", "n_words", "n_removed", "kept"],
    )


def dedup_words(docs: DataFrame, digest: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed`` and ``kept`` for every row of ``docs``.

    A word goes when a window of 20 consecutive words covers it whose sequence also starts
    earlier: in a document with a smaller id, or before it in its own. ``kept`` is what is
    left, joined by single spaces; with ``digest`` its SHA-256 stands there instead, as
    ``kept_sha256``. Words are runs of characters other than [\\x20\\x09-\\x0D], unchanged.
    Windows are judged on the input, so of two places the later one goes even where the
    earlier is cut for another reason.

    Null and empty texts have no words. A null id is neither smaller nor larger than another:
    such rows lose only what they themselves repeat, and take nothing from others. Rows that
    share an id have no order among one another, so they lose nothing to each other; they
    share one list of first windows, so ids should tell documents apart. Texts with under 20
    words stay whole. All rows stay; other columns are not read.
    """
    rows = docs.select(column(docs, "doc_id").alias("id"), column(docs, "text").alias("text"))
    kind = dict(rows.dtypes)["id"]
    named = rows.where(F.col("id").isNotNull())
    # An anchor that stands once in the corpus rules windows out.
    alone = stored(
        named.mapInArrow(batches(_anchor_rows, _BATCH), f"id {kind}, anchor long")
        .groupBy("anchor")
        .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id"))
        .where(F.col("n") == 1)
        .groupBy("id")
        .agg(F.collect_list("anchor").alias("alone")),
        "anchors",
    )
    none = F.lit(None).cast("array<long>")
    judging = batches(_candidates, _BATCH)
    judged = stored(
        named.join(alone, "id", "left")
        .select("id", "text", "alone")
        .mapInArrow(judging, f"id {kind}, text string, {_CANDIDATES}"),
        "windows",
    )
    discard(alone)
    mine = stored(
        judged.select("id", "text", "first")
        .where(F.size("first") > 0)
        .mapInArrow(batches(_windows, _BATCH), f"id {kind}, a long, b long")
        .groupBy("a", "b")
        .agg(F.min("id").alias("id"))
        .groupBy("id")
        .agg(F.collect_list("a").alias("mine")),
        "firsts",
    )
    own = (
        rows.where(F.col("id").isNull())
        .select("id", "text", none.alias("alone"))
        .mapInArrow(judging, f"id {kind}, text string, {_CANDIDATES}")
        .withColumn("mine", none)
    )
    # Texts without a candidate are not moved again.
    some = (F.size("first") > 0) | (F.size("again") > 0)
    clean = judged.where(~some).withColumn("mine", none)
    touched = judged.where(some).join(mine, "id", "left").select("id", "text", "first", "again", "mine")
    cut = clean.union(touched).union(own).mapInArrow(
        batches(_cleaned, _BATCH), f"id {kind}, n_words long, n_removed long, kept string"
    )
    if digest:
        kept = F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256")
    else:
        kept = F.col("kept")
    return cut.select(F.col("id").alias("doc_id"), "n_words", "n_removed", kept)


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(table(spark, sf_dir, "documents"), digest=True)


# All windows, as texts.
OP12_SQL = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS sequence
    FROM words, unnest(range(1, len(w) - 18)) AS r(i)
), late AS (
    SELECT doc_id, i FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY sequence ORDER BY doc_id, i) AS place FROM windows
    ) WHERE place > 1
), gone AS (
    SELECT DISTINCT doc_id, i + k AS pos FROM late, unnest(range(0, 20)) AS r(k)
), each AS (
    SELECT doc_id, pos, word
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words)
), marked AS (
    SELECT e.doc_id, e.pos, e.word, g.pos IS NOT NULL AS removed
    FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos
), texts AS (
    SELECT doc_id, count(*) FILTER (WHERE removed) AS n_removed,
        string_agg(word, ' ' ORDER BY pos) FILTER (WHERE NOT removed) AS kept
    FROM marked GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(t.n_removed, 0)::BIGINT AS n_removed,
    sha256(coalesce(t.kept, '')) AS kept_sha256
FROM words d LEFT JOIN texts t ON d.doc_id = t.doc_id
"""

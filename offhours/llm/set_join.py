"""Exact Jaccard join of word n-gram sets, and the classes that its links make.

Shingles are put in one global order, rare ones first, and each set lists its
first few (the prefix): two similar sets share a shingle of their prefixes. What
is said of one list entry or one set is then used to skip others (after Wang,
Qin, Lin, Zhang and Chang, 2017):

* Index lists are cut into blocks of entries of near size and position; a pair
  of blocks whose best case cannot reach the threshold is passed over at once.
* Equal sets are one set. Sets alike in a few hashes are compared with the most
  ordinary one among them first; those found similar to it form a family, whose
  members' mutual answers follow from it and are not looked for again.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from offhours.llm.shared import (
    BATCH_BYTES, batches, begin, column, components, cuts, give_back, sieve, sifted, spare, stored, table,
)
from offhours.llm.text import mixed, paired, word_hashes

WIDTH = 3
PERCENT = 90
COUNT_BITS = 22
_PART_BITS = 18
BLOCK = 256
LIST = 4096
# Turn one hash function into several.
_TURNS = (0x1F83D9AB, 0x5BE0CD19, 0x9B05688C, 0x510E527F)


# -- sets ------------------------------------------------------------------------------


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text.

    Shingles are known by 64-bit hashes. A text of fewer words than ``width`` has
    its whole sequence as one shingle, one without words none.
    """
    counts, h = word_hashes(texts)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    rolled = h
    for j in range(1, width):
        rolled = paired(rolled[:-1], h[j:]) if len(rolled) > 1 else rolled[:0]
    out = []
    for n, start in zip(counts.tolist(), bounds.tolist()):
        if n >= width:
            out.append(np.unique(rolled[start : start + n - width + 1]))
        elif n:
            whole = h[start : start + 1]
            for j in range(1, n):
                whole = paired(whole, h[start + j : start + j + 1])
            out.append(mixed(whole + np.uint64(n)))
        else:
            out.append(h[:0])
    return out


def set_id(values: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(values.tobytes(), digest_size=8).digest(), "little", signed=True)


def _text_key(docs: DataFrame) -> Column:
    return F.xxhash64(column(docs, "doc_id"), column(docs, "text"))


def _surveyed(docs: DataFrame, width: int) -> DataFrame:
    """One pass over the texts: a row per document, and how often shingles occur.

    Kind 0: ``id``, ``n``, ``sid`` (null for an empty set), ``key`` of id and text. Kind 1: counts of the
    shingles of this task by the first COUNT_BITS bits of their hash, in parts.
    The counts only order the shingles, so they may be rough; they have the same
    size whatever the data.
    """

    def run(it):
        begin(__name__)
        counts = np.zeros(1 << COUNT_BITS, np.uint32)
        for batch in (b.slice(start, stop - start) for b in it for start, stop in cuts(b, BATCH_BYTES, 2000)):
            sets = shingle_sets(batch.column(2), width)
            first_bits = np.concatenate([*sets, np.empty(0, np.uint64)]) >> np.uint64(64 - COUNT_BITS)
            # In place: the counts of a batch by themselves would be twice as large.
            np.add.at(counts, first_bits.astype(np.int64), np.uint32(1))
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.zeros(n, np.int32)),
                    batch.column(0),
                    pa.array([len(v) for v in sets], pa.int64()),
                    pa.array([set_id(v) if len(v) else None for v in sets], pa.int64()),
                    batch.column(1),
                    pa.nulls(n, pa.binary()),
                ],
                ["kind", "id", "n", "sid", "key", "counts"],
            )
        for part, some in enumerate(counts.reshape(-1, 1 << _PART_BITS)):
            if some.any():
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([1], pa.int32()),
                        pa.nulls(1, id_type),
                        pa.array([part], pa.int64()),
                        pa.nulls(1, pa.int64()),
                        pa.nulls(1, pa.int64()),
                        pa.array([np.minimum(some, 65535).astype(np.uint16).tobytes()]),
                    ],
                    ["kind", "id", "n", "sid", "key", "counts"],
                )
        give_back()

    kind, id_type = dict(docs.dtypes)["doc_id"], to_arrow_type(docs.schema["doc_id"].dataType)
    rows = docs.select(
        column(docs, "doc_id").alias("id"), _text_key(docs).alias("key"), column(docs, "text").alias("text")
    )
    schema = f"kind int, id {kind}, n long, sid long, key long, counts binary"
    return stored(rows.mapInArrow(run, schema), "survey")


def _levels(survey: DataFrame) -> np.ndarray:
    """For each first bits of a hash, the logarithm of how many shingles have them."""

    def total(frame: pa.Table, kind) -> np.ndarray:
        out = np.zeros(1 << _PART_BITS, np.uint64)
        for some in frame["counts"].to_pylist():
            out += np.frombuffer(some, kind).astype(np.uint64)
        return out

    def add(frame: pa.Table) -> pa.Table:
        return pa.table({"n": frame["n"].slice(0, 1), "counts": [total(frame, np.uint16).tobytes()]})

    def level(frame: pa.Table) -> pa.Table:
        counts = np.maximum(total(frame, np.uint64), 1)
        levels = np.ceil(4 * np.log2(counts)).astype(np.uint8)
        return pa.table({"n": frame["n"].slice(0, 1), "levels": [levels.tobytes()]})

    parts = survey.where("kind = 1").select("n", "counts")
    # Two steps, so that no task adds up the counts of very many others.
    some = parts.groupBy("n", F.pmod(F.xxhash64("counts"), F.lit(32))).applyInArrow(add, "n long, counts binary")
    found = some.groupBy("n").applyInArrow(level, "n long, levels binary")
    out = np.zeros(1 << COUNT_BITS, np.uint8)
    for row in found.toLocalIterator():  # 2 ** COUNT_BITS bytes in all
        out[row["n"] << _PART_BITS : (row["n"] + 1) << _PART_BITS] = np.frombuffer(row["levels"], np.uint8)
    return out


def ordered(values: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Keys of shingles whose order is the global one: rarer first."""
    level = levels[(values >> np.uint64(64 - COUNT_BITS)).astype(np.int64)].astype(np.uint64)
    return np.sort((level << np.uint64(55)) | (values & np.uint64((1 << 55) - 1)))


def at_least(n: int, percent: int) -> int:
    """Smallest overlap that a set of size n has with any similar one."""
    return -(-n * percent // 100)


def _prefixes(docs: DataFrame, levels: np.ndarray, width: int, percent: int) -> DataFrame:
    """Each different set once: ``sid``, ``n``, ``prefix``, ``alike``, ``rarest``."""
    known = docs.sparkSession.sparkContext.broadcast(levels.tobytes())

    def run(batch):
        table_of_levels = np.frombuffer(known.value, np.uint8)
        rows = {}
        for values in shingle_sets(batch.column(0), width):
            if not len(values):
                continue
            sid = set_id(values)
            if sid in rows:
                continue
            n = len(values)
            keys = ordered(values, table_of_levels)[: n - at_least(n, percent) + 1]
            least = [mixed(values ^ np.uint64(turn)).min(keepdims=True) for turn in _TURNS]
            alike = [int(paired(a, b).view(np.int64)[0]) for a, b in zip(least[::2], least[1::2])]
            rows[sid] = (sid, n, keys.view(np.int64).tolist(), alike, int(keys[0] >> np.uint64(55)))
        if not rows:
            return None
        columns = list(zip(*rows.values()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(columns[0], pa.int64()),
                pa.array(columns[1], pa.int32()),
                pa.array(columns[2], pa.list_(pa.int64())),
                pa.array(columns[3], pa.list_(pa.int64())),
                pa.array(columns[4], pa.int32()),
            ],
            ["sid", "n", "prefix", "alike", "rarest"],
        )

    made = docs.select(column(docs, "text").alias("text")).where(F.col("text").isNotNull()).mapInArrow(
        batches(run), "sid long, n int, prefix array<long>, alike array<long>, rarest int"
    )
    return stored(made.dropDuplicates(["sid"]), "prefixes")


# -- answers -----------------------------------------------------------------------------


def similar(pairs: DataFrame, docs: DataFrame, sids: DataFrame, width: int, percent: int) -> DataFrame:
    """Those of the pairs (``a``, ``b``) of sets that are similar, by their whole sets.

    ``sids`` has a document (``id``) for each ``sid``. Only documents whose ids pass
    the sieve of the needed ones are read as sets again.
    """
    pairs = stored(pairs, "pairs")
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select(F.col("b").alias("sid"))).distinct()
    needed = sids.join(wanted, "sid").select("sid", F.xxhash64("id").alias("key"))
    rows = docs.select(
        F.xxhash64(column(docs, "doc_id")).alias("key"), column(docs, "text").alias("text")
    )
    some = sifted(rows, "key", sieve(needed, "key"), "likely").where("likely").select("text")

    def run(batch):
        sets = [v for v in shingle_sets(batch.column(0), width) if len(v)]
        return pa.RecordBatch.from_arrays(
            [pa.array([set_id(v) for v in sets], pa.int64()), pa.array([v.tobytes() for v in sets], pa.binary())],
            ["sid", "values"],
        )

    made = (
        some.mapInArrow(batches(run), "sid long, values binary")
        .join(wanted, "sid", "left_semi")
        .dropDuplicates(["sid"])
    )
    sets = stored(made, "sets")
    both = pairs.join(sets.select(F.col("sid").alias("a"), F.col("values").alias("x")), "a").join(
        sets.select(F.col("sid").alias("b"), F.col("values").alias("y")), "b"
    ).select("a", "b", "x", "y")

    def compare(batch):
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        return pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).filter(pa.array(keep))

    return stored(both.mapInArrow(batches(compare), "a long, b long"), "links")


def matches(n: np.ndarray, at: np.ndarray, family: np.ndarray, percent: int):
    """Pairs (places i, j) of entries of one list that may be similar, block by block.

    A pair passes when its sizes allow it and, were this shingle the first that
    both share, what follows in both could still make up the overlap. Entries come
    sorted by size. Members of one family are no pair.
    """
    left = n - at  # what the list's shingle and those behind it can contribute
    for s in range(0, len(n), BLOCK):
        a = slice(s, s + BLOCK)
        for t in range(s, len(n), BLOCK):
            b = slice(t, t + BLOCK)
            if n[t] * percent > 100 * n[a][-1]:
                break  # all further blocks hold larger sets still
            least = -(-(n[a][0] + n[t]) * percent // (100 + percent))
            if min(left[a].max(), left[b].max()) < least:
                continue
            if family[a].min() == family[b].max() and family[a].max() == family[b].min():
                continue
            need = -(-(n[a][:, None] + n[b][None, :]) * percent // (100 + percent))
            good = np.minimum(left[a][:, None], left[b][None, :]) >= need
            good &= n[b][None, :] * percent <= 100 * n[a][:, None]
            good &= family[a][:, None] != family[b][None, :]
            if s == t:
                good = np.triu(good, 1)
            i, j = np.nonzero(good)
            if len(i):
                yield s + i, t + j


def _candidates(entries: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets that share a prefix shingle and may be similar.

    ``entries``: ``token``, ``p``, ``q`` (blocks of a long list; null ``q`` else),
    ``side``, ``n``, ``at``, ``sid``, ``family``, sorted by list inside partitions.
    """

    def of_list(cols, lo, hi):
        n, at, sid, family, side = (c[lo:hi] for c in cols)
        order = np.argsort(n, kind="stable")
        n, at, sid, family, side = n[order], at[order], sid[order], family[order], side[order]
        if side[0] >= 0 and side.min() != side.max():
            # Two blocks of one long list: only pairs across count here.
            for i, j in matches(n, at, family, percent):
                across = side[i] != side[j]
                yield sid[i[across]], sid[j[across]]
        else:
            for i, j in matches(n, at, family, percent):
                yield sid[i], sid[j]

    def emit(found):
        if not found:
            return None
        a = np.concatenate([f[0] for f in found])
        b = np.concatenate([f[1] for f in found])
        a, b = np.minimum(a, b), np.maximum(a, b)
        pairs = np.unique(np.stack([a, b]), axis=1) if len(a) else np.empty((2, 0), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    def run(it):
        kept = None
        for batch in it:
            fresh = [batch.column(i).to_numpy() for i in range(batch.num_columns)]
            kept = fresh if kept is None else [np.concatenate([o, f]) for o, f in zip(kept, fresh)]
            token, p, q = kept[:3]
            if not len(token):
                continue
            new = (token[1:] != token[:-1]) | (p[1:] != p[:-1]) | (q[1:] != q[:-1])
            cuts = np.concatenate([[0], np.flatnonzero(new) + 1])
            # The last list may go on in the next batch.
            found = [
                pair
                for lo, hi in zip(cuts[:-1], cuts[1:])
                if hi - lo > 1
                for pair in of_list(kept[3:], lo, hi)
            ]
            kept = [c[cuts[-1] :] for c in kept]
            out = emit(found)
            if out is not None:
                yield out
        if kept is not None and len(kept[0]) > 1:
            out = emit(list(of_list(kept[3:], 0, len(kept[0]))))
            if out is not None:
                yield out

    return entries.mapInArrow(run, "a long, b long").distinct()


def _entries(prefixes: DataFrame, families: DataFrame) -> DataFrame:
    """Index entries by list; the entries of long lists in pairs of blocks."""
    with_family = prefixes.join(families, "sid", "left").select(
        "sid", "n", F.coalesce("family", "sid").alias("family"), "prefix"
    )
    entries = with_family.select("sid", "n", "family", F.posexplode("prefix").alias("at", "token"))
    sizes = prefixes.select(F.explode("prefix").alias("token")).groupBy("token").count()
    long = stored(sizes.where(F.col("count") > LIST), "long-lists")
    parted = sifted(entries, "token", sieve(long, "token"), "likely")
    order = ["token", "p", "q", "n", "at", "sid", "family", "side"]
    zero, none = F.lit(0), F.lit(-1)
    short = parted.where(~F.col("likely")).select(
        "token", zero.alias("p"), zero.alias("q"), "n", "at", "sid", "family", none.alias("side")
    )
    some = parted.where("likely").join(long, "token", "left")
    blocks = F.coalesce(F.ceil(F.col("count") / LIST), F.lit(1)).cast("int")
    mine = F.pmod(F.xxhash64("sid"), blocks).cast("int")
    split = (
        some.withColumn("blocks", blocks)
        .withColumn("side", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "token",
            F.least("side", "other").alias("p"),
            F.greatest("side", "other").alias("q"),
            "n", "at", "sid", "family", "side",
        )
    )
    return (
        short.union(split).select(*order)
        .repartition("token", "p", "q")
        .sortWithinPartitions("token", "p", "q")
    )


def links(docs: DataFrame, survey: DataFrame, width: int, percent: int) -> DataFrame:
    """Similar pairs (``a``, ``b``) of different sets that connect all similar ones.

    Pairs inside a family are left to the links with its leader.
    """
    rows = survey.where("kind = 0 AND sid IS NOT NULL")
    sids = rows.groupBy("sid").agg(F.min("id").alias("id"))
    prefixes = _prefixes(docs, _levels(survey), width, percent)
    # The leader of an alike group is its most ordinary set: a copy's own shingles are rare.
    groups = prefixes.select("sid", "rarest", F.explode("alike").alias("alike"))
    leaders = groups.groupBy("alike").agg(
        F.max(F.struct("rarest", "sid")).alias("leader"), F.count(F.lit(1)).alias("n")
    ).where(F.col("n") > 1)
    stars = (
        groups.join(leaders.select("alike", F.col("leader.sid").alias("leader")), "alike")
        .where(F.col("sid") != F.col("leader"))
        .select(F.least("sid", "leader").alias("a"), F.greatest("sid", "leader").alias("b"))
        .distinct()
    )
    first = similar(stars, docs, sids, width, percent)
    families = stored(
        components(first).select(F.col("node").alias("sid"), F.col("component").alias("family")), "families"
    )
    found = _candidates(_entries(prefixes, families), percent)
    fresh = found.join(stars, ["a", "b"], "left_anti")
    return first.union(similar(fresh, docs, sids, width, percent))


def _classes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """Every row's ``id``, ``n``, ``sid``, ``key`` and the smallest id of its class, ``least``."""
    survey = _surveyed(docs, width)
    classes = components(links(docs, survey, width, percent)).select(F.col("node").alias("sid"), "component")
    rows = survey.where("kind = 0").select("id", "n", "sid", "key")
    # Rows of one set combine map-side before anything is joined.
    own = rows.where("sid IS NOT NULL").groupBy("sid").agg(F.min("id").alias("own"))
    named = own.join(classes, "sid", "left").select(
        "sid", "own", F.coalesce("component", "sid").alias("component")
    )
    least = named.groupBy("component").agg(F.min("own").alias("least"))
    ids = named.join(least, "component").select("sid", "least")
    return rows.join(ids, "sid", "left").withColumn(
        "least", F.when(F.col("sid").isNull(), F.col("id")).otherwise(F.col("least"))
    )


def jaccard_classes(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` for each row of ``docs``.

    Rows link when 100 times the intersection of their shingle sets is at least
    ``percent`` times the union; the component is the smallest id that links
    reach. Words are cut at ASCII white space, A-Z in lower case. Rows without
    words or text have no shingles and link with nothing: their component is
    their own id. Repeated rows have equal sets and link, also under one id. A
    null id is never the smallest, unless the class has no other. An empty table
    gives an empty result; other columns are not read.
    """
    return _classes(docs, width, percent).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("least").alias("component_id")
    )


def one_of_each(docs: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each class: the one with the smallest id.

    Rows without words are classes of their own and stay. Of rows that agree in id
    and text one stays.
    """
    rows = stored(_classes(docs, width, percent).select("id", "sid", "key", "least"), "classes")
    other = ~F.col("id").eqNullSafe(F.col("least"))
    gone = rows.where("sid IS NOT NULL").where(other).select("key").distinct()
    again = rows.where("sid IS NOT NULL").groupBy("key").count().where("count > 1").select("key")
    key, gone_mark, again_mark = spare(docs, "key"), spare(docs, "gone"), spare(docs, "again")
    keyed = docs.withColumn(key, _text_key(docs))
    # Only rows that the sieves let pass, hardly more than those meant, are moved.
    parted = sifted(keyed, key, sieve(gone, "key"), gone_mark)
    parted = sifted(parted, key, sieve(again, "key"), again_mark)
    clear = parted.where(~F.col(gone_mark) & ~F.col(again_mark))
    moved = parted.where(F.col(gone_mark) | F.col(again_mark))
    kept = moved.join(gone.withColumnRenamed("key", key), key, "left_anti")
    repeated = kept.join(again.withColumnRenamed("key", key), key, "left_semi").dropDuplicates([key])
    single = kept.join(again.withColumnRenamed("key", key), key, "left_anti")
    own = ["`" + c.replace("`", "``") + "`" for c in docs.columns]
    return clear.select(*own).union(single.select(*own)).union(repeated.select(*own))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


OP4_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(
    string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\\x20\\x09-\\x0D]+'),
    lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')]
    ELSE [] END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n
  HAVING 100 * count(*) >= 90 * (x.n + y.n - count(*))
), reach AS (
  SELECT a, b FROM links
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least AS (
  SELECT a, min(b) AS least FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
       coalesce(least(d.doc_id, least.least), d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN least ON least.a = d.doc_id
"""

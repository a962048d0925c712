"""How filters share the work: the Hart-Mas-Colell potential of the removal game.

In the removal game of a part of the corpus a coalition of filters is worth the
documents that at least one of them removes. The potential of the empty coalition
is 0 and that of S is ``P(S) = (v(S) + sum of P(S without i) over i in S) / |S|``;
the Shapley value of a filter is the potential of all filters minus that of all but
this one. What a filter removes at a step of an order is a difference of two
coalitions, so no order is ever run over the documents.

A document counts by the set of filters that it fails: at most 32 numbers per part,
whatever the size of the corpus. All of this is done with built-in functions.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offhours.llm.shared import column, stored, table

FILTERS = "ABCDE"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITALS_PERCENT = 2
_COPY = 1 << FILTERS.index("E")
_EVERY = (1 << len(FILTERS)) - 1
# A multiple of 1 to 5, so that potentials times it are whole numbers.
_SCALE = 60
_GAMES = ("docs", "good", "toxic")


def text_faults(text: Column) -> Column:
    """Filters A to D that a text fails, as bits 0 to 3; null is an empty text.

    A: under 200 words. B: 100 * distinct words < 50 * words. C: 100 * characters
    A-Z > 2 * code points. D: any of ``#$%&*|``. Words are maximal runs of characters
    other than [\\x20\\x09-\\x0D], case counts.
    """
    text = F.coalesce(text, F.lit(""))
    # Empty strings stand at most at both ends. Without lambdas Spark splits each text once.
    pieces = F.split(text, r"[\x20\x09-\x0D]+")
    ahead = (F.element_at(pieces, 1) == "").cast("int")
    behind = (F.element_at(pieces, -1) == "").cast("int")
    n = (F.size(pieces) - F.least(ahead + behind, F.size(pieces))).cast("long")
    distinct = (F.size(F.array_distinct(pieces)) - F.greatest(ahead, behind)).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    fails = [
        n < MIN_WORDS,
        100 * distinct < MIN_DISTINCT_PERCENT * n,
        100 * capitals > MAX_CAPITALS_PERCENT * F.length(text).cast("long"),
        text.rlike("[#$%&*|]"),
    ]
    bits = [F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)]
    return bits[0] + bits[1] + bits[2] + bits[3]


def fault_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part``, ``faults``, ``good``, ``toxic`` and ``n``: documents by the filters they fail.

    ``faults`` has a bit per filter. E, the fifth, is failed by a document whose text a
    smaller id bears; texts are known by their SHA-256. Texts do not move: a digest, the
    id and the four other filters stand for each document. Copies are added up before
    each shuffle, so a text, a source or an id that a third of all rows bear is a few
    rows a task. Rows without an id fail E never, make nothing fail it, and have no labels.
    """
    text = column(docs, "text")
    rows = docs.select(
        column(docs, "doc_id").alias("id"),
        F.coalesce(column(docs, "source").cast("string"), F.lit("")).alias("part"),
        text_faults(text).alias("faults"),
        F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256).alias("digest"),
    )
    rows = rows.withColumn("digest", F.unhex("digest"))
    each = stored(
        rows.groupBy("id", "part", "faults", "digest").agg(F.count(F.lit(1)).alias("n")), "audited"
    )
    marks = (
        labels.where(column(labels, "doc_id").isNotNull())
        .groupBy(column(labels, "doc_id").alias("id"))
        .agg(
            F.max(F.coalesce((column(labels, "quality") == 1).cast("int"), F.lit(0))).alias("good"),
            F.max(F.coalesce((column(labels, "toxic") == 1).cast("int"), F.lit(0))).alias("toxic"),
        )
    )
    alike = each.where(F.col("id").isNotNull()).join(marks, "id", "left").select(
        "id", "part", "faults", "digest", "n",
        F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )
    least = alike.groupBy("digest").agg(F.min("id").alias("least"))
    # The first documents of the texts; whatever else bears their texts is a copy.
    first = alike.join(least.select("digest", F.col("least").alias("id")), ["id", "digest"], "left_semi")
    counts = ["part", "faults", "good", "toxic"]
    fresh = first.groupBy(*counts).agg(F.sum("n").alias("n"))
    every = alike.groupBy(*counts).agg(F.sum("n").alias("n"))
    copies = every.union(fresh.select(*counts, -F.col("n"))).withColumn(
        "faults", F.col("faults").bitwiseOR(F.lit(_COPY))
    )
    nameless = each.where(F.col("id").isNull()).select(
        "part", "faults", F.lit(0).alias("good"), F.lit(0).alias("toxic"), "n"
    )
    return (
        fresh.union(copies).union(nameless).groupBy(*counts).agg(F.sum("n").alias("n")).where("n > 0")
    )


def coalitions(counts: DataFrame) -> DataFrame:
    """One row per part: for each game an array with the worth of the 32 coalitions.

    Coalition S stands at its bit set, from 0. ``docs`` counts what S removes, ``good``
    and ``toxic`` only such with these labels; ``total`` is the number of documents.
    """

    removed = F.expr("if(faults & coalition != 0, n, 0L)")
    worths = (
        counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit(_EVERY))))
        .groupBy("part", "coalition")
        .agg(
            F.sum("n").alias("total"),
            F.sum(removed).alias("docs"),
            F.sum(removed * F.col("good")).alias("good"),
            F.sum(removed * F.col("toxic")).alias("toxic"),
        )
    )
    inner = F.array_sort(F.collect_list(F.struct("coalition", *_GAMES)))
    return worths.groupBy("part").agg(F.max("total").alias("total"), inner.alias("w")).select(
        "part", "total", *[F.col("w").getField(g).alias(g) for g in _GAMES]
    )


def potentials(worth: Column) -> Column:
    """Potentials of all coalitions, times 60, from their worths (both by bit set).

    Coalitions come in the order of their bit sets, so those without one member of S
    stand before S, and each potential is taken from the ones that are there.
    """

    return F.aggregate(
        F.sequence(F.lit(1), F.lit(_EVERY)),
        F.array(F.lit(0).cast("long")),
        lambda known, s: F.concat(known, F.array(_potential(worth, known, s))),
    )


def _potential(worth: Column, known: Column, s: Column) -> Column:
    """60 P(s), from 60 P of smaller numbers: a whole number, so the division is exact."""
    members = F.filter(
        F.array(*[F.lit(1 << i) for i in range(len(FILTERS))]), lambda bit: s.bitwiseAND(bit) != 0
    )
    rest = F.aggregate(members, F.lit(0).cast("long"), lambda acc, bit: acc + F.get(known, s - bit))
    return F.call_function("div", _SCALE * F.get(worth, s) + rest, F.size(members).cast("long"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step.

    ``part`` is the source (null: empty text), ``filter_order`` one of the 120 orders and
    ``step`` the place in it, from 1. ``kept`` counts the documents left after the step,
    ``removed`` those that go in it, ``redundant`` those that fail its filter but went
    earlier, ``unique_fails`` those that fail no other filter, ``good_lost`` and
    ``toxic_lost`` those of ``removed`` with these labels, and ``shapley`` is what the
    filter removes, summed over all orders.

    Every row of ``docs`` counts, repeated ones too: rows of one id and text are copies of
    nothing but smaller ids. Null and empty texts are one text. Of several labels of an id
    any 1 counts. Without documents there are no rows. Other columns are not read.
    """
    games = coalitions(fault_counts(docs, labels))
    parts = games.withColumn("potential", potentials(F.col("docs")))
    orders = F.split(F.lit(" ".join(map("".join, permutations(FILTERS)))), " ")
    steps = parts.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS))))
    )

    def chosen(at: Column) -> Column:
        """Bit of the filter at a place of the order."""
        return F.element_at(
            F.create_map(*[x for i, f in enumerate(FILTERS) for x in (F.lit(f), F.lit(1 << i))]),
            F.substring(F.col("filter_order"), at, F.lit(1)),
        )

    steps = steps.withColumn("own", chosen(F.col("step"))).withColumn(
        "before",
        F.aggregate(
            F.sequence(F.lit(1), F.col("step")), F.lit(0), lambda acc, k: acc + chosen(k)
        )
        - F.col("own"),
    )
    after = F.col("before") + F.col("own")

    def gained(game: str) -> Column:
        return F.get(game, after) - F.get(game, F.col("before"))

    full, rest = F.lit(_EVERY), F.lit(_EVERY) - F.col("own")
    per_order = len(list(permutations(FILTERS))) // _SCALE
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.get("docs", after)).alias("kept"),
        gained("docs").alias("removed"),
        (F.get("docs", F.col("own")) - gained("docs")).alias("redundant"),
        (F.get("docs", full) - F.get("docs", rest)).alias("unique_fails"),
        gained("good").alias("good_lost"),
        gained("toxic").alias("toxic_lost"),
        (per_order * (F.get("potential", full) - F.get("potential", rest))).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# Each order is run over the kinds of documents, and Shapley values are sums over orders.
OP13_SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), firsts AS (
    SELECT coalesce(text, '') AS text, min(doc_id) AS least FROM documents GROUP BY 1
), marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
        max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), failing AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        concat(
            CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
            CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
            CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 2 * length(d.text)
                THEN 'C' ELSE '' END,
            CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 'D' ELSE '' END,
            CASE WHEN d.doc_id > least THEN 'E' ELSE '' END
        ) AS fails
    FROM words d JOIN firsts f ON d.text = f.text LEFT JOIN marks m ON d.doc_id = m.doc_id
), kinds AS (
    SELECT part, good, toxic, fails, count(*) AS n FROM failing GROUP BY ALL
), letters AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x)
        AND c.x NOT IN (d.x, e.x) AND d.x <> e.x
), places AS (
    SELECT filter_order, s.step, substring(filter_order, s.step, 1) AS own
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s
), runs AS (
    SELECT part, filter_order, step, own, good, toxic, n, fails,
        coalesce((SELECT min(strpos(filter_order, l.x)) FROM letters l WHERE contains(fails, l.x)), 6) AS gone
    FROM kinds, places
), steps AS (
    SELECT part, filter_order, step, any_value(own) AS own,
        sum(CASE WHEN gone > step THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed,
        sum(CASE WHEN gone < step AND contains(fails, own) THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
        sum(CASE WHEN gone = step THEN n * good ELSE 0 END) AS good_lost,
        sum(CASE WHEN gone = step THEN n * toxic ELSE 0 END) AS toxic_lost
    FROM runs GROUP BY part, filter_order, step
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
    redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
    good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
    (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM steps
"""

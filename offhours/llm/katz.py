"""Katz back-off language model: counts, discounts, back-off weights and scores.

P(v | u) is d(r) r / c(u) for a pair (u, v) seen r times, else alpha(u) P(v); the
unigram P(v) is discounted in the same way and leaves what it frees to one class
of unknown words. d are Good-Turing discounts for counts up to K (Katz, 1987);
alpha(u) is what the discounts free behind u over what the unigram gives to words
not seen there, so each distribution adds up to exactly 1.

Nearly all word pairs of a large corpus are rare, so a row per pair would be many
times the input. The corpus is therefore kept as chunks of some million tokens;
what a chunk needs to know of its distinct words and pairs is asked of tables that
are partitioned by hash, as sorted arrays of 64-bit keys, and answered in the same
order. Every pair is owned by one chunk, which adds it to its context's sums.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offhours.llm.shared import column, stored, table
from offhours.llm.text import paired, word_hashes
from offhours.session import fresh_folder

K = 5
FOLDS, HELD = 7, 2
CHUNK = 2_000_000
# Keys of the two tokens that are no words; hashes of words are above them.
END, START = np.uint64(2), np.uint64(3)
_LEAST_WORD = np.uint64(16)


# -- arrays as bytes -------------------------------------------------------------------


def pack(a: np.ndarray) -> bytes:
    """An array of numbers as bytes: byte planes, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()
    return len(a).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(data: bytes, kind) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    planes = pa.decompress(data[8:], n * width, codec="zstd")
    return np.frombuffer(planes, np.uint8).reshape(width, n).T.copy().view(kind).reshape(n)


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted keys, as differences."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


# -- chunks ----------------------------------------------------------------------------


def held_out(doc_id: Column, folds: int = FOLDS, held: int = HELD) -> Column:
    """Whether a document is kept from training; a null id counts as an empty text."""
    text = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % folds == held


def _write_chunks(docs: DataFrame, chunk: int) -> DataFrame:
    """The corpus as rows of about ``chunk`` tokens, bucketed by chunk.

    The bucketing lets the two later passes over the chunks meet their answers
    without the corpus being moved.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]

    def run(it: Iterator[pa.RecordBatch]):
        part, number = TaskContext.get().partitionId(), 0
        kept, size = [], 0

        def flush():
            ids = pa.concat_arrays([k[0] for k in kept])
            held = np.concatenate([k[1] for k in kept])
            counts = np.concatenate([k[2] for k in kept])
            words, inverse, n = np.unique(
                np.concatenate([k[3] for k in kept]), return_inverse=True, return_counts=True
            )
            # Words by falling frequency: small numbers for most tokens.
            order = np.argsort(-n, kind="stable")
            rank = np.empty(len(order), np.int32)
            rank[order] = np.arange(len(order), dtype=np.int32)
            row = {
                "chunk": (part << 32) + number,
                "ids": ids,
                "held": pack(held),
                "counts": pack(counts.astype(np.int32)),
                "words": pack(words[order]),
                "tokens": pack(rank[inverse]),
            }
            return pa.RecordBatch.from_arrays(
                [pa.array([row["chunk"]])]
                + [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)]
                + [pa.array([row[name]], pa.binary()) for name in ("held", "counts", "words", "tokens")],
                list(row),
            )

        for batch in it:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                counts, h = word_hashes(some.column(2))
                h = np.maximum(h, _LEAST_WORD)
                kept.append((some.column(0), some.column(1).to_numpy(zero_copy_only=False), counts, h))
                size += len(h) + some.num_rows
                if size >= chunk:
                    yield flush()
                    kept, size, number = [], 0, number + 1
        if kept:
            yield flush()

    name = f"katz_{uuid.uuid4().hex}"
    rows = docs.select(
        column(docs, "doc_id").alias("id"),
        held_out(column(docs, "doc_id")).alias("held"),
        column(docs, "text").alias("text"),
    ).mapInArrow(
        run, f"chunk long, ids array<{kind}>, held binary, counts binary, words binary, tokens binary"
    )
    # Fewer buckets than this and Spark would move the chunks after all.
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        rows.write.bucketBy(buckets, "chunk")
        .option("path", fresh_folder(spark, "katz-chunks"))
        .saveAsTable(name)
    )
    return spark.table(name)


class Chunk:
    """A chunk's documents as pairs of neighbouring tokens."""

    def __init__(self, row: dict):
        self.held = unpack(row["held"], np.bool_)
        self.counts = unpack(row["counts"], np.int32).astype(np.int64)
        words = unpack(row["words"], np.uint64)
        tokens = unpack(row["tokens"], np.int32)
        docs, size = len(self.counts), len(tokens)
        self.words = np.concatenate([words, [END, START]])
        end, start = len(words), len(words) + 1
        # Every document is its words between a start and an end.
        lengths = self.counts + 2
        stops = np.cumsum(lengths)
        line = np.empty(size + 2 * docs, np.int64)
        inside = np.ones(len(line), bool)
        inside[stops - 1] = inside[stops - lengths] = False
        line[inside] = tokens
        line[stops - 1], line[stops - lengths] = end, start
        real = np.ones(len(line), bool)
        real[stops - lengths] = False
        at = np.flatnonzero(real)
        self.u, self.v = line[at - 1], line[at]
        self.doc = np.repeat(np.arange(docs), self.counts + 1)
        self.train = ~self.held[self.doc]
        self.end, self.start = end, start

    def pairs(self):
        """(sorted distinct keys, number of each pair's key, first pair of each key)."""
        keys = paired(self.words[self.u], self.words[self.v])
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        return distinct, inverse, first


def _slices(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where the sorted keys of each hash range begin."""
    edges = np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits) if bits else np.empty(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


_ASK = "range int, chunk long, words binary, word_n binary, pairs binary, pair_n binary"


def _ask(bits: int):
    """Each chunk's questions to each hash range: its distinct keys and their training counts."""

    def run(it):
        for batch in it:
            for row in batch.to_pylist():
                chunk = Chunk(row)
                keys, inverse, _ = chunk.pairs()
                n = np.bincount(inverse, weights=chunk.train, minlength=len(keys)).astype(np.int32)
                order = np.argsort(chunk.words)
                words = chunk.words[order]
                word_n = np.bincount(chunk.v, weights=chunk.train, minlength=len(words))
                # A start is a context but no token; it counts as often as texts begin.
                word_n[chunk.start] = (~chunk.held).sum()
                word_n = word_n.astype(np.int32)[order]
                a, b = _slices(words, bits), _slices(keys, bits)
                rows = [
                    (
                        i, row["chunk"],
                        pack_keys(words[a[i] : a[i + 1]]), pack(word_n[a[i] : a[i + 1]]),
                        pack_keys(keys[b[i] : b[i + 1]]), pack(n[b[i] : b[i + 1]]),
                    )
                    for i in range(1 << bits)
                    if a[i] < a[i + 1] or b[i] < b[i + 1]
                ]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int64())]
                    + [pa.array(c, pa.binary()) for c in cols[2:]],
                    ["range", "chunk", "words", "word_n", "pairs", "pair_n"],
                )

    return run


def _totals(keys: list[np.ndarray], n: list[np.ndarray]):
    """(distinct keys, which of them each entry is, their summed counts)."""
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, inverse, np.bincount(inverse, np.concatenate(n), len(distinct)).astype(np.int64)


def _count_of_counts(total: np.ndarray) -> list[int]:
    return np.bincount(np.minimum(total, K + 2), minlength=K + 3)[: K + 2].tolist()


def _spread(total: np.ndarray) -> list[list[int]]:
    """Each count above 0 and how many things have it."""
    return [x.tolist() for x in np.unique(total[total > 0], return_counts=True)]


_ANSWER = (
    "range int, chunk long, word_c binary, many binary, pair_r binary, own binary, stats array<long>,"
    " spread array<array<long>>"
)


def _answer(frame: pa.Table) -> pa.Table:
    """Counts of one hash range: to each chunk those of its keys, and who owns each pair.

    ``many`` says which words other chunks hold too.

    ``stats``, on one row of the range: tokens, distinct tokens, texts, then how many
    words and how many pairs occur 0 to K + 1 times. ``spread``, beside it: the counts
    of words, how many words have each, and the same of pairs.
    """
    frame = frame.sort_by("chunk")
    rows = frame.to_pylist()
    words = [unpack_keys(r["words"]) for r in rows]
    pairs = [unpack_keys(r["pairs"]) for r in rows]
    pair_n = [unpack(r["pair_n"], np.int32) for r in rows]
    distinct, word_at, word_c = _totals(words, [unpack(r["word_n"], np.int32) for r in rows])
    _, pair_at, pair_r = _totals(pairs, pair_n)
    seen = np.flatnonzero(np.concatenate(pair_n) > 0)
    own = np.zeros(len(pair_at), bool)
    own[seen[np.unique(pair_at[seen], return_index=True)[1]]] = True
    held_by = np.bincount(word_at, minlength=len(distinct))
    starts = word_c[distinct == START].sum()
    counted = word_c[distinct != START]
    stats = [int(counted.sum()), int((counted > 0).sum()), int(starts)]
    stats += _count_of_counts(counted) + _count_of_counts(pair_r)
    spread = _spread(counted) + _spread(pair_r)
    out, w, p = [], 0, 0
    for i, r in enumerate(rows):
        a, b = slice(w, w + len(words[i])), slice(p, p + len(pairs[i]))
        w, p = a.stop, b.stop
        out.append(
            (
                r["range"], r["chunk"],
                pack(word_c[word_at[a]]), pack(held_by[word_at[a]] > 1), pack(pair_r[pair_at[b]].astype(np.int32)), pack(own[b]),
                stats if i == 0 else None,
                spread if i == 0 else None,
            )
        )
    cols = list(zip(*out))
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4, pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))]
    names = ["range", "chunk", "word_c", "many", "pair_r", "own", "stats", "spread"]
    return pa.table({name: pa.array(c, kind) for name, c, kind in zip(names, cols, kinds)})


# -- the model -------------------------------------------------------------------------


def discounts(n: list[int]) -> np.ndarray:
    """d(0) to d(K) from the numbers of things seen 0 to K + 1 times.

    Good-Turing as Katz scales it, so that counts above K stay whole. Where the
    counts of counts do not allow it (a discount outside 0 to 1, as in small or
    copied texts), absolute discounting by n1 / (n1 + 2 n2) takes its place for all.
    """
    d = np.ones(K + 1)
    if n[1] and all(n[1 : K + 2]):
        a = (K + 1) * n[K + 1] / n[1]
        if a < 1:
            r = np.arange(1, K + 1)
            d[1:] = ((r + 1) * np.array(n[2 : K + 2]) / (r * np.array(n[1 : K + 1])) - a) / (1 - a)
            if (d[1:] > 0).all() and (d[1:] < 1).all():
                return d
    cut = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
    d[1:] = 1 - cut / np.arange(1, K + 1)
    return d


def smooth_discounts(spread: dict[int, int]) -> np.ndarray:
    """d(0) to d(K) from all counts r and how many things have each.

    Katz's formula on counts of counts smoothed by Gale's log-linear fit (Gale and
    Sampson, 1995): each n(r) is spread over the gap to its neighbours, and a line
    is laid through their logarithms. Copies, which lift single counts of counts,
    leave the discounts between 0 and 1 as long as the line falls by more than 1.
    Where it does not, or where there is no line, ``discounts`` decides.
    """
    r = np.array(sorted(spread), np.float64)
    n = np.array([spread[int(x)] for x in r], np.float64)
    if len(r) > 1:
        below = np.concatenate([[0], r[:-1]])
        above = np.concatenate([r[1:], [2 * r[-1] - below[-1]]])
        slope = np.polyfit(np.log(r), np.log(2 * n / (above - below)), 1)[0]
        a = (K + 1.0) ** (slope + 1)
        if a < 1:
            low = np.arange(1, K + 1)
            d = np.ones(K + 1)
            d[1:] = (((low + 1) / low) ** (slope + 1) - a) / (1 - a)
            return d
    return discounts([spread.get(i, 0) for i in range(K + 2)])


class Model:
    """What every chunk needs to know besides its answers; a few numbers.

    With ``spreads``, of words and of pairs, the discounts are smoothed.
    """

    def __init__(self, stats: list[int], spreads: tuple[dict, dict] | None = None):
        self.tokens, self.types, self.texts = stats[:3]
        word_n, pair_n = stats[3 : 3 + K + 2], stats[3 + K + 2 :]
        if spreads is None:
            self.word_d, self.pair_d = discounts(word_n), discounts(pair_n)
        else:
            self.word_d, self.pair_d = map(smooth_discounts, spreads)
        r = np.arange(K + 1)
        freed = float(((1 - self.word_d) * r * np.array(word_n[: K + 1]))[1:].sum())
        # Were nothing freed, unknown words would get one count on top.
        self.all = self.tokens if freed > 0 else self.tokens + 1
        self.unknown = (freed if freed > 0 else 1.0) / max(1, self.all)

    def discounted(self, r: np.ndarray, d: np.ndarray) -> np.ndarray:
        return np.where(r <= K, r * d[np.minimum(r, K)], r)

    def unigram(self, c: np.ndarray) -> np.ndarray:
        known = self.discounted(c, self.word_d) / max(1, self.all)
        return np.where(c > 0, known, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.tokens + 1 * (self.types + 1)))

    @staticmethod
    def weights(c: np.ndarray, used: np.ndarray, lower: np.ndarray) -> np.ndarray:
        """Back-off weights of contexts seen ``c`` times.

        ``used`` is the sum of the discounted counts behind the context, ``lower`` the
        unigram probability of the words seen there. Where the discounts freed nothing
        the context counts once more, for the words not seen; such weights come out
        negative, to mark it.
        """
        c = np.maximum(c, 1)
        none = c - used <= 1e-9 * c
        free = np.where(none, 1 / (c + 1), (c - used) / c)
        return np.where(none, -1.0, 1.0) * free / np.maximum(1 - lower, 1e-300)


class Answered:
    """A chunk with the counts of its words and pairs."""

    def __init__(self, row: dict, answers: pa.Table, model: Model):
        self.chunk = chunk = Chunk(row)
        rows = [r for r in answers.to_pylist() if r["pair_r"] is not None]
        rows.sort(key=lambda r: r["range"])
        order = np.argsort(chunk.words)
        self.c = np.empty(len(order), np.int64)
        self.c[order] = np.concatenate([unpack(r["word_c"], np.int64) for r in rows])
        self.order = order
        _, self.inverse, first = chunk.pairs()
        self.r = np.concatenate([unpack(r["pair_r"], np.int32) for r in rows]).astype(np.int64)
        own = np.concatenate([unpack(r["own"], np.bool_) for r in rows])
        # Sums of the owned pairs by context.
        u, v = chunk.u[first[own]], chunk.v[first[own]]
        size = len(self.c)
        self.p = model.unigram(self.c)
        self.used = np.bincount(u, model.discounted(self.r[own], model.pair_d), size)
        self.lower = np.bincount(u, self.p[v], size)
        # A word that no other chunk holds has all its pairs here.
        many = np.empty(size, bool)
        many[order] = np.concatenate([unpack(r["many"], np.bool_) for r in rows])
        self.shared = many & (self.c > 0)
        self.model = model


_SUMS = "range int, chunk long, words binary, c binary, used binary, lower binary"


def _sums(bits: int, model: Model):
    """What a chunk's owned pairs add to the contexts that other chunks hold too."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row in left.to_pylist():
            known = Answered(row, right, model)
            order = known.order[known.shared[known.order]]
            words = known.chunk.words[order]
            a = _slices(words, bits)
            for i in range(1 << bits):
                if a[i] < a[i + 1]:
                    s = order[a[i] : a[i + 1]]
                    out.append(
                        (
                            i, row["chunk"], pack_keys(known.chunk.words[s]), pack(known.c[s]),
                            pack(known.used[s]), pack(known.lower[s]),
                        )
                    )
        cols = list(zip(*out)) or [[]] * 6
        kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
        names = ["range", "chunk", "words", "c", "used", "lower"]
        return pa.table({name: pa.array(c, kind) for name, c, kind in zip(names, cols, kinds)})

    return run


def _weigh(frame: pa.Table) -> pa.Table:
    """Back-off weights of one hash range's contexts, to each chunk those it asked for."""
    rows = frame.sort_by("chunk").to_pylist()
    keys = [unpack_keys(r["words"]) for r in rows]
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    used = np.bincount(at, np.concatenate([unpack(r["used"], np.float64) for r in rows]), len(distinct))
    lower = np.bincount(at, np.concatenate([unpack(r["lower"], np.float64) for r in rows]), len(distinct))
    c = np.zeros(len(distinct), np.int64)
    c[at] = np.concatenate([unpack(r["c"], np.int64) for r in rows])
    weights = Model.weights(c, used, lower)[at]
    ends = np.cumsum([len(k) for k in keys])
    return pa.table(
        {
            "range": pa.array([r["range"] for r in rows], pa.int32()),
            "chunk": pa.array([r["chunk"] for r in rows], pa.int64()),
            "weights": pa.array([pack(w) for w in np.split(weights, ends[:-1])], pa.binary()),
        }
    )


def _evaluate(model: Model):
    """Scores of a chunk's documents."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = []
        for row, ids in zip(left.drop_columns(["ids"]).to_pylist(), left["ids"].combine_chunks()):
            known = Answered(row, right, model)
            chunk = known.chunk
            weights = Model.weights(known.c, known.used, known.lower)
            asked = known.order[known.shared[known.order]]
            given = [r for r in right.to_pylist() if r["weights"] is not None]
            given.sort(key=lambda r: r["range"])
            if given:
                weights[asked] = np.concatenate([unpack(r["weights"], np.float64) for r in given])
            weights[known.c == 0] = 1.0
            r, u, v = known.r[known.inverse], chunk.u, chunk.v
            # Behind a context whose discounts freed nothing all counts are whole.
            whole = weights[u] < 0
            times = np.maximum(known.c[u], 1)
            seen = np.where(whole, r / (times + 1), model.discounted(r, model.pair_d) / times)
            p = np.where(r > 0, seen, np.abs(weights[u]) * known.p[v])
            docs = len(chunk.counts)
            out.append(
                pa.table(
                    {
                        "doc_id": ids.values,
                        "held_out": pa.array(chunk.held),
                        "n_tokens": pa.array(chunk.counts + 1),
                        "n_known": pa.array(
                            np.bincount(chunk.doc, known.c[v] > 0, docs).astype(np.int64)
                        ),
                        "train_tokens": pa.array(np.full(docs, model.tokens, np.int64)),
                        "base_score": pa.array(np.bincount(chunk.doc, model.base(known.c)[v], docs)),
                        "score": pa.array(np.bincount(chunk.doc, np.log10(p), docs)),
                    }
                )
            )
        return pa.concat_tables(out)

    return run


def _spreads(answers: DataFrame) -> tuple[dict, dict]:
    """How many words, and how many pairs, have each count; a row per distinct count."""
    out = []
    for i in (0, 2):
        rows = (
            answers.where("spread IS NOT NULL")
            .select(F.explode(F.arrays_zip(F.col("spread")[i].alias("r"), F.col("spread")[i + 1].alias("n"))).alias("x"))
            .groupBy("x.r").agg(F.sum("x.n").alias("n"))
        )
        out.append({r["r"]: r["n"] for r in rows.toLocalIterator()})
    return tuple(out)


def katz_scores(docs: DataFrame, chunk: int = CHUNK, smoothed: bool = False) -> DataFrame:
    """Scores of all texts under a bigram model of those that are not held out.

    Columns: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (add-one unigrams) and ``score``, both log10 probabilities of the
    text's words and its end. Words are cut at ASCII white space, A-Z in lower case,
    and known by 64-bit hashes. ``smoothed`` takes the discounts from smoothed counts
    of counts (``smooth_discounts``), so that copies among the texts do not rule
    Good-Turing out; without it they are taken from the plain ones (``discounts``).

    Null and empty texts are an end alone. Rows are scored one by one: repeated rows
    and null ids stay. With nothing to train on every token is the unknown one, with
    probability 1. An empty table gives an empty result; other columns are not read.
    """
    kind = dict(docs.dtypes)["doc_id"]
    chunks = _write_chunks(docs, chunk)
    n = chunks.select("chunk").count()
    bits = max(1, int(np.ceil(np.log2(max(2, n)))))
    answers = stored(
        chunks.mapInArrow(_ask(bits), _ASK).groupBy("range").applyInArrow(_answer, _ANSWER), "katz-counts"
    )
    size = 3 + 2 * (K + 2)
    sums = answers.where("stats IS NOT NULL").agg(
        *[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(size)]
    ).first()
    model = Model([s or 0 for s in sums], _spreads(answers) if smoothed else None)
    counts = answers.select(
        "range", "chunk", "word_c", "many", "pair_r", "own", F.lit(None).cast("binary").alias("weights")
    )
    # The corpus stays where it is; what is small comes to it.
    added = chunks.groupBy("chunk").cogroup(counts.groupBy("chunk")).applyInArrow(_sums(bits, model), _SUMS)
    weights = stored(
        added.groupBy("range").applyInArrow(_weigh, "range int, chunk long, weights binary"), "katz-weights"
    )
    none = F.lit(None).cast("binary")
    right = counts.union(
        weights.select("range", "chunk", *[none.alias(c) for c in counts.columns[2:6]], "weights")
    )
    return chunks.groupBy("chunk").cogroup(right.groupBy("chunk")).applyInArrow(
        _evaluate(model),
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double",
    )


def op3_katz_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"), smoothed=True)

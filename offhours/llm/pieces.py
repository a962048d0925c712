"""SentencePiece-style encoding with seeded merge-dropout, and its exact inverse.

Text is cut where no merge can cross: before a run of spaces, and around
characters that no piece of several characters holds. Inside a segment the best
candidate merge is taken from an agenda, as in byte-pair encoding; a candidate
is skipped when its keyed hash falls below the dropout rate. What remains are
pieces that merges make, so every such segmentation decodes to the same text.

Every occurrence of a segment draws for itself: its document and place enter the
hash of each candidate. What an agenda does next depends on nothing but which of its
candidates were skipped so far, so each segment has a tree of decisions, and all
occurrences walk the trees together, each with its own hashes. One that takes a way
that nobody has taken before runs through its agenda, and the tree grows by that way.
"""

from __future__ import annotations

import heapq
import re
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offhours.llm.shared import batches, column, keeps, table
from offhours.llm.text import mixed

MODEL = "piece_bpe_32k.model"
DROPOUT = 0.1
SEED = 20
VARIANTS = None
# Occurrences whose merges are drawn together.
_DRAWN = 1 << 17
CACHE = 1 << 19
_MARK = "▁"
_ALL = (1 << 64) - 1
_TURN = 0x9E3779B97F4A7C15
_NONE = (1 << 31) - 1
_CELLS = 1 << 18
# Segments beyond this many symbols have linked neighbours and a heap of their own.
_LONG = 256


class Pieces:
    """A BPE vocabulary: ids of pieces, what merges into them, where text may be cut."""

    def __init__(self, model: str):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        self.ids, self.byte_ids, self.as_bytes, scores = {}, {}, [], {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(piece[3:-1], 16)
                self.byte_ids[value] = i
                self.as_bytes.append(bytes([value]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.as_bytes.append(b"")
            else:
                self.ids[piece] = i
                scores[piece] = sp.get_score(i)
                self.as_bytes.append(piece.replace(_MARK, " ").encode())
        self.byte_lengths = np.array([len(b) for b in self.as_bytes])
        self.byte_starts = np.cumsum(self.byte_lengths) - self.byte_lengths
        self.all_bytes = np.frombuffer(b"".join(self.as_bytes), np.uint8)
        merging = {c for p in self.ids if len(p) > 1 for c in p} - {_MARK}
        inner = re.escape("".join(sorted(merging)))
        # Segments: spaces with what may merge behind them, or one character alone.
        # The mark itself is no space here: in a text it is encoded as bytes.
        self.segment = re.compile(f" *[{inner}]+| +|[^{inner} ]")
        # Symbols: pieces, and characters that only stand inside of pieces.
        symbols = dict(self.ids)
        for c in merging:
            symbols.setdefault(c, len(symbols) + sp.get_piece_size())
        self._of_point = np.full(0x110000, -2, np.int64)
        for symbol, i in symbols.items():
            if len(symbol) == 1:
                self._of_point[ord(symbol)] = i
        pairs = {
            (symbols[p[:i]], symbols[p[i:]]): p
            for p in self.ids
            for i in range(1, len(p))
            if p[:i] in symbols and p[i:] in symbols
        }
        # Better scores first; ranks are whole numbers, so that they can be compared exactly.
        ranks = {score: rank for rank, score in enumerate(sorted(set(scores.values()), reverse=True))}
        self._table(pairs, {p: (self.ids[p], ranks[scores[p]]) for p in self.ids})

    def _table(self, pairs: dict, target: dict) -> None:
        """Pairs of symbols with the piece they make, as an open hash table."""
        bits = max(4, (4 * len(pairs)).bit_length())
        self._shift = np.uint64(64 - bits)
        self._keys = np.full(1 << bits, -1, np.int64)
        self._made = np.zeros(1 << bits, np.int32)
        self._rank = np.full(1 << bits, _NONE, np.int32)
        for (left, right), piece in pairs.items():
            key = left << 20 | right
            at = int(np.uint64(key * _TURN & _ALL) >> self._shift)
            while self._keys[at] >= 0:
                at = (at + 1) & ((1 << bits) - 1)
            self._keys[at] = key
            self._made[at], self._rank[at] = target[piece]

    def merges(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) that each pair of symbols makes; the rank is _NONE if none."""
        key = left.astype(np.int64) << 20 | right
        last = len(self._keys) - 1
        at = ((key.view(np.uint64) * np.uint64(_TURN)) >> self._shift).astype(np.int64)
        found = self._keys[at]
        open_ = np.flatnonzero((found != key) & (found >= 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & last
            found = self._keys[at[open_]]
            open_ = open_[(found != key[open_]) & (found >= 0)]
        hit = self._keys[at] == key
        return np.where(hit, self._rank[at], _NONE), self._made[at]

    def _merge(self, left: int, right: int) -> tuple[int, int]:
        """`merges` of one pair."""
        if left < 0 or right < 0:
            return _NONE, 0
        key = left << 20 | right
        last = len(self._keys) - 1
        at = (key * _TURN & _ALL) >> int(self._shift)
        while (found := int(self._keys[at])) != key:
            if found < 0:
                return _NONE, 0
            at = (at + 1) & last
        return int(self._rank[at]), int(self._made[at])

    def encode_segments(
        self, segments: list[str], keys: np.ndarray, rate: int, trace: list | None = None
    ) -> list[bytes]:
        """Ids (little-endian int32) of segments, all taken through their agendas together.

        Each step takes every segment's best candidate off its agenda: the piece with
        the best score, the leftmost of equals. A candidate whose keyed hash, of the
        segment's key and the candidate's place, is below ``rate`` (in 1 / 2**24) is
        skipped for good; the others are merged, which makes new candidates. Long
        segments are taken one by one, which gives the same. ``trace`` is set to the
        candidates of the others in order: number of the segment, place, whether skipped.
        """
        out: list[bytes] = [b""] * len(segments)
        texts = [s.replace(" ", _MARK) for s in segments]
        sizes = np.array([len(t) for t in texts])
        order = np.argsort(sizes, kind="stable")
        short = int(np.searchsorted(sizes[order], _LONG, side="right"))
        for i in order[short:].tolist():
            out[i] = self._alone(texts[i], int(keys[i]), rate)
        # Segments of like length, in blocks of bounded size.
        at, done = 0, []
        while at < short:
            longest = max(8, int(sizes[order[at]]) * 3 // 2)
            stop = at + int(np.searchsorted(sizes[order[at:short]], longest, side="right"))
            stop = min(stop, at + max(1, _CELLS // longest))
            some = order[at:stop]
            steps = []
            for i, ids in zip(some, self._block([texts[i] for i in some], keys[some], rate, steps)):
                out[i] = ids
            if trace is not None:
                done += [(some[rows], places, skips) for rows, places, skips in steps]
            at = stop
        if trace is not None:
            rows, places, skips = map(np.concatenate, zip(*done)) if done else (np.empty(0, int),) * 3
            steps = np.argsort(rows, kind="stable")
            trace[:] = rows[steps], places[steps].astype(np.uint64), skips[steps].astype(bool)
        for i, s in enumerate(segments):
            if len(s) == 1 and s == _MARK:
                out[i] = self._bytes_of(s)
        return out

    def _alone(self, text: str, key: int, rate: int) -> bytes:
        """One segment with linked neighbours and a heap: its size times its logarithm in steps."""
        n = len(text)
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        whole = self._of_point[points]
        ranks, made = self._pairs(whole[:-1], whole[1:])
        symbol, made = whole.tolist(), made.tolist()
        behind, before = list(range(1, n + 1)), list(range(-1, n - 1))
        agenda = [(r, a, a + 1, a + 2, made[a]) for a, r in enumerate(ranks.tolist()) if r != _NONE]
        heapq.heapify(agenda)

        def offer(a: int, b: int) -> None:
            rank, piece = self._merge(symbol[a], symbol[b])
            if rank != _NONE:
                heapq.heappush(agenda, (rank, a, b, behind[b], piece))

        while agenda:
            _, a, b, c, piece = heapq.heappop(agenda)
            if behind[a] != b or behind[b] != c:
                continue  # one of the two has been merged since
            if rate and _mixed(key ^ _mixed((a << 40 | b << 20 | c) & _ALL)) >> 40 < rate:
                continue
            symbol[a], behind[a], behind[b] = piece, c, -1
            if c < n:
                before[c] = a
                offer(a, c)
            if before[a] >= 0:
                offer(before[a], a)
        out, a = [], 0
        while a < n:
            i = symbol[a]
            plain = 0 <= i < len(self.as_bytes)
            out.append(np.array([i], "<i4").tobytes() if plain else self._bytes_of(text[a : behind[a]]))
            a = behind[a]
        return b"".join(out)

    def _bytes_of(self, text: str) -> bytes:
        return np.array([self.byte_ids[b] for b in text.encode("utf-8", "surrogatepass")], "<i4").tobytes()

    def _block(self, texts: list[str], keys: np.ndarray, rate: int, done: list) -> list[bytes]:
        rows, wide = len(texts), max(map(len, texts))
        symbol = np.full((rows, wide + 1), -1, np.int64)
        size = np.array([len(t) for t in texts])
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        flat = self._of_point[points]
        inside = np.arange(wide + 1) < size[:, None]
        symbol[inside] = flat
        # Where each symbol begins; behind the last one stands the end of the text.
        begin = np.minimum(np.arange(wide + 2), size[:, None]).astype(np.int64)
        rank = np.full((rows, wide + 1), _NONE, np.int32)
        piece = np.zeros((rows, wide + 1), np.int32)
        rank[:, :wide], piece[:, :wide] = self._pairs(symbol[:, :-1], symbol[:, 1:])
        alive = np.arange(rows)
        columns = np.arange(wide + 1)
        while len(alive):
            best = rank[alive].argmin(1)
            some = rank[alive, best] < _NONE
            alive, best = alive[some], best[some]
            if not len(alive):
                break
            a, b = begin[alive, best], begin[alive, best + 1]
            c = begin[alive, best + 2]
            place = (a << 40 | b << 20 | c).astype(np.uint64)
            skip = mixed(keys[alive] ^ mixed(place)) >> np.uint64(40) < np.uint64(rate)
            rank[alive[skip], best[skip]] = _NONE
            row, j = alive[~skip], best[~skip]
            done.append((alive, place, skip))
            if not len(row):
                continue
            # The two symbols become one; what stands behind them moves up.
            symbol[row, j] = piece[row, j]
            behind = columns > j[:, None]
            source = np.minimum(columns + behind, wide)
            last = behind[:, -1]
            symbol[row] = np.take_along_axis(symbol[row], source, 1)
            symbol[row[last], wide] = -1
            rank[row] = np.take_along_axis(rank[row], source, 1)
            piece[row] = np.take_along_axis(piece[row], source, 1)
            rank[row, wide] = _NONE
            starts = begin[row]
            moved = np.take_along_axis(starts, source, 1)
            starts[:, : wide + 1] = moved
            begin[row] = starts
            rank[row, j], piece[row, j] = self._pairs(symbol[row, j], symbol[row, j + 1])
            left = j > 0
            row, j = row[left], j[left]
            rank[row, j - 1], piece[row, j - 1] = self._pairs(symbol[row, j - 1], symbol[row, j])
        kept = symbol[:, :-1]
        there = kept != -1
        ends = np.cumsum(there.sum(1))
        flat = kept[there]
        odd = (flat < 0) | (flat >= len(self.as_bytes))
        whole = flat.astype("<i4").tobytes()
        bounds = [0, *(4 * ends).tolist()]
        out = [whole[a:b] for a, b in zip(bounds, bounds[1:])]
        # Characters that are no pieces become bytes.
        for i in np.unique(np.searchsorted(ends, np.flatnonzero(odd), side="right")):
            ids, starts = kept[i][there[i]].tolist(), begin[i].tolist()
            out[i] = b"".join(
                np.array([n], "<i4").tobytes() if 0 <= n < len(self.as_bytes) else self._bytes_of(texts[i][a:b])
                for n, a, b in zip(ids, starts, starts[1:])
            )
        return out

    def _pairs(self, left: np.ndarray, right: np.ndarray):
        rank, piece = self.merges(np.maximum(left, 0).ravel(), np.maximum(right, 0).ravel())
        rank = np.where(((left < 0) | (right < 0)).ravel(), _NONE, rank)
        return rank.reshape(left.shape), piece.reshape(left.shape)

    def lossless(self, values: np.ndarray, counts: np.ndarray, texts: list[str]) -> list[bool]:
        """Whether each text's ids decode to it: their bytes against the text's, behind a space."""
        whole = self.all_bytes[_ranges(self.byte_starts[values], self.byte_lengths[values])].tobytes()
        sums = np.concatenate([[0], np.cumsum(self.byte_lengths[values])])
        ends = sums[np.concatenate([[0], np.cumsum(counts)])].tolist()
        # Every text but an empty one got a space ahead.
        return [
            whole[a:b] == (b" " + t.encode("utf-8", "surrogatepass") if t else b"")
            for t, a, b in zip(texts, ends, ends[1:])
        ]

    def decode(self, ids) -> str:
        """The text that was encoded; the space that encoding set before it goes."""
        whole = b"".join(map(self.as_bytes.__getitem__, ids))
        return (whole[1:] if whole[:1] == b" " else whole).decode("utf-8", "replace")


def _mixed(a: int) -> int:
    """`mixed` of one number."""
    a ^= a >> 33
    a = a * 0xFF51AFD7ED558CCD & _ALL
    a ^= a >> 33
    a = a * 0xC4CEB9FE1A85EC53 & _ALL
    return a ^ a >> 33


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[0], starts[0] + 1, ...`` for each range of the given length, one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


@lru_cache(maxsize=2)
def pieces(model: str) -> Pieces:
    """Loaded once per Python worker."""
    return Pieces(model)


class Decisions:
    """The agendas of segments as trees: a node is a candidate, a leaf the ids that come out.

    Numbers from 0 on are nodes, -1 is what nobody has come to yet, and those below are
    leaves. A segment's tree begins with the way that its first occurrence took.
    """

    def __init__(self):
        self.roots: dict[str, int] = {}
        self.nodes = self.leaves = self.size = 0
        self._place = np.empty(1 << 10, np.uint64)
        self._child = np.empty((1 << 10, 2), np.int32)
        self._start = np.empty(1 << 10, np.int64)
        self._length = np.empty(1 << 10, np.int64)
        self._values = np.empty(1 << 12, np.int32)

    def _leaf(self, ids: list[bytes]) -> np.ndarray:
        """New leaves, as numbers."""
        first, self.leaves = self.leaves, self.leaves + len(ids)
        start, self.size = self.size, self.size + sum(map(len, ids)) // 4
        for name, need in (("_start", self.leaves), ("_length", self.leaves), ("_values", self.size)):
            setattr(self, name, _roomy(getattr(self, name), need))
        lengths = np.array([len(x) // 4 for x in ids], np.int64)
        self._length[first : self.leaves] = lengths
        self._start[first : self.leaves] = start + np.cumsum(lengths) - lengths
        self._values[start : self.size] = np.frombuffer(b"".join(ids), "<i4")
        return -2 - np.arange(first, self.leaves)

    def _ways(self, places: np.ndarray, skips: np.ndarray, counts: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """New ways of ``counts`` candidates, each down to its leaf; their beginnings."""
        first, self.nodes = self.nodes, self.nodes + len(places)
        self._place, self._child = _roomy(self._place, self.nodes), _roomy(self._child, self.nodes)
        self._place[first : self.nodes] = mixed(places)
        behind = np.arange(first + 1, self.nodes + 1)
        ends = np.cumsum(counts)
        behind[ends[counts > 0] - 1] = leaves[counts > 0]
        self._child[first : self.nodes] = -1
        self._child[np.arange(first, self.nodes), skips.astype(int)] = behind
        return np.where(counts > 0, first + ends - counts, leaves)

    def add(self, segments: list[str], ids: list[bytes], trace: list) -> None:
        """Segments with one way each."""
        rows, places, skips = trace
        counts = np.bincount(rows, minlength=len(segments))
        self.roots.update(zip(segments, self._ways(places, skips, counts, self._leaf(ids)).tolist()))

    def walk(self, state: np.ndarray, keys: np.ndarray, rate: int) -> tuple[np.ndarray, ...]:
        """From roots to leaves; where a way ends before, -1 and its last node, decision and depth."""
        state = state.copy()
        last, turn = np.full(len(state), -1, np.int64), np.zeros(len(state), np.int64)
        depth = np.zeros(len(state), np.int64)
        active = np.flatnonzero(state >= 0)
        steps = 0
        while len(active):
            at = state[active]
            skip = mixed(keys[active] ^ self._place[at]) >> np.uint64(40) < np.uint64(rate)
            to = self._child[at, skip.astype(np.int8)]
            state[active] = to
            lost = to == -1
            if lost.any():
                some = active[lost]
                last[some], turn[some], depth[some] = at[lost], skip[lost], steps
            active = active[to >= 0]
            steps += 1
        return state, last, turn, depth

    def grow(self, last, turn, depth, ids: list[bytes], trace: list) -> np.ndarray:
        """Leaves of ways that were run because the trees ended; the trees grow by them."""
        rows, places, skips = trace
        leaves = self._leaf(ids)
        counts = np.bincount(rows, minlength=len(ids))
        starts = np.cumsum(counts) - counts
        # Of several that fell off at the same place one is enough; long segments have no trees.
        on = np.flatnonzero(last >= 0)
        some = on[np.unique(last[on] * 2 + turn[on], return_index=True)[1]]
        rest = counts[some] - depth[some] - 1
        taken = _ranges(starts[some] + depth[some] + 1, rest)
        self._child[last[some], turn[some]] = self._ways(places[taken], skips[taken], rest, leaves[some])
        return leaves

    def ids(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each leaf, all ids in order)."""
        lengths = self._length[-2 - state]
        return lengths, self._values[_ranges(self._start[-2 - state], lengths)]


def _roomy(a: np.ndarray, need: int) -> np.ndarray:
    """``a``, or a copy with twice the room that is needed."""
    if need <= len(a):
        return a
    more = np.empty((2 * need, *a.shape[1:]), a.dtype)
    more[: len(a)] = a
    return more


class Encoder:
    """Encodes texts; segments met before are looked up, in a cache of bounded size.

    With ``variants`` None each occurrence is drawn by document and place, and the
    cache holds trees of decisions; else each segment has so many segmentations.
    """

    def __init__(self, model: str, rate: float, seed: int, variants: int | None, cache: int = CACHE):
        self.vocabulary = pieces(model)
        self.rate, self.seed = round(rate * (1 << 24)), seed & _ALL
        self.drawn = variants is None and self.rate > 0
        self.variants = variants if self.rate and variants else 1
        self.most = max(1, cache // self.variants)
        self.known: list[dict[str, bytes]] = [{} for _ in range(self.variants)]
        self.decisions = Decisions()

    def flat(self, texts: list[str], streams: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids in order). ``streams`` tell documents apart."""
        if not self.drawn:
            found = self.encode(texts, streams)
            return np.array([len(x) // 4 for x in found], np.int64), np.frombuffer(b"".join(found), "<i4")
        find = self.vocabulary.segment.findall
        done, some, at, size = [], [], [], 0
        for t, stream in zip(texts, streams):
            some.append(find(" " + t) if t else [])
            at.append(stream)
            size += len(some[-1])
            if size >= _DRAWN:
                done.append(self._drawn(some, at))
                some, at, size = [], [], 0
        done.append(self._drawn(some, at))
        counts, values = zip(*done)
        return np.concatenate(counts), np.concatenate(values)

    def encode(self, texts: list[str], streams: list[int]) -> list[bytes]:
        """Ids of each text as little-endian int32. ``streams`` tell documents apart."""
        if self.drawn:
            counts, values = self.flat(texts, streams)
            whole, ends = values.astype("<i4").tobytes(), [0, *(4 * np.cumsum(counts)).tolist()]
            return [whole[a:b] for a, b in zip(ends, ends[1:])]
        find, known = self.vocabulary.segment.findall, self.known
        if any(len(k) >= self.most for k in known):
            for k in known:
                k.clear()
        gets = [k.get for k in known]
        parts, new = [], [set() for _ in known]
        for t, stream in zip(texts, streams):
            segments = find(" " + t) if t else []
            variant = self._variants(len(segments), stream)
            found = [gets[v](s) for v, s in zip(variant, segments)]
            missing = [(i, variant[i], segments[i]) for i, ids in enumerate(found) if ids is None]
            for _, v, s in missing:
                new[v].add(s)
            parts.append((found, missing))
        for v, some in enumerate(new):
            if some:
                some = sorted(some)
                ids = self.vocabulary.encode_segments(some, self._keys(some, v), self.rate)
                known[v].update(zip(some, ids))
        out = []
        for found, missing in parts:
            for i, v, s in missing:
                found[i] = known[v][s]
            out.append(b"".join(found))
        return out

    def _drawn(self, texts: list[list[str]], streams: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """`flat` of texts that are cut into segments."""
        sizes = np.array([len(t) for t in texts], np.int64)
        if not sizes.sum():
            return sizes, np.empty(0, np.int32)
        tree = self.decisions
        if max(tree.nodes, tree.size) > 4 * self.most or len(tree.roots) > self.most // 2:
            tree = self.decisions = Decisions()
        coded = pa.array([s for t in texts for s in t], pa.string()).dictionary_encode()
        segments, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        keys = np.concatenate([self._places(n, s) for n, s in zip(sizes.tolist(), streams)])
        # The first occurrence of a new segment goes its own way, which is where its tree begins.
        new = [i for i, s in enumerate(segments) if s not in tree.roots and len(s) <= _LONG]
        if new:
            trace: list = []
            names = [segments[i] for i in new]
            first = np.unique(code, return_index=True)[1][new]
            tree.add(names, self.vocabulary.encode_segments(names, keys[first], self.rate, trace), trace)
        roots = np.array([tree.roots.get(s, -1) for s in segments], np.int64)
        state, last, turn, depth = tree.walk(roots[code], keys, self.rate)
        lost = np.flatnonzero(state == -1)
        if len(lost):
            trace = []
            other = [segments[c] for c in code[lost].tolist()]
            ids = self.vocabulary.encode_segments(other, keys[lost], self.rate, trace)
            state[lost] = tree.grow(last[lost], turn[lost], depth[lost], ids, trace)
        lengths, values = tree.ids(state)
        sums = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(sizes)])]
        return np.diff(sums), values

    def _places(self, n: int, stream: int) -> np.ndarray:
        """Keys of a document's occurrences, by seed, document and place."""
        seed = mixed(np.array([self.seed], np.uint64))
        first = mixed(np.array([stream & _ALL], np.uint64) ^ seed)
        return mixed(np.arange(n, dtype=np.uint64) + first)

    def _variants(self, n: int, stream: int) -> list[int]:
        """Which of its segment's variants each occurrence takes depends on its place."""
        if self.variants == 1:
            return [0] * n
        first = mixed(np.array([(stream + self.seed) & _ALL], np.uint64))
        places = mixed(np.arange(n, dtype=np.uint64) + first)
        return (places % np.uint64(self.variants)).tolist()

    def _keys(self, segments: list[str], variant: int) -> np.ndarray:
        hashes = pd.util.hash_array(np.array(segments, object), categorize=False)
        return mixed(hashes ^ mixed(np.array([(self.seed * 1_000_003 + variant) & _ALL], np.uint64)))


@lru_cache(maxsize=2)
def encoder(model: str, rate: float, seed: int, variants: int | None) -> Encoder:
    return Encoder(model, rate, seed, variants)


keeps(__name__, encoder.cache_clear)


def encode(
    docs: DataFrame,
    model: str = MODEL,
    dropout: float = DROPOUT,
    seed: int = SEED,
    variants: int | None = VARIANTS,
    id_column: str = "doc_id",
    text: str = "text",
    kept: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, ``ids``, ``n_ids`` and ``lossless`` for each row of ``docs``, then the columns ``kept``.

    The same seed, id and text give the same ids; another seed gives others. Each
    occurrence of a segment is varied for itself, by document and place; with
    ``variants`` a segment has only so many segmentations per seed. ``dropout`` 0 gives the plain encoding of the library. ``lossless``
    says that decoding the ids gave the text back. A null text has null ids and
    no ``lossless``; an empty one has none and is lossless. Rows are treated one
    by one: repeated rows and null ids (as id 0) stay, and other columns are not
    read.
    """

    def run(batch):
        coder = encoder(model, dropout, seed, variants)
        texts = batch.column(2).to_pylist()
        nulls = [t is None for t in texts]
        texts = [t or "" for t in texts]
        sizes, values = coder.flat(texts, batch.column(1).to_pylist())
        same = coder.vocabulary.lossless(values, sizes, texts)
        same = [None if null else s for null, s in zip(nulls, same)]
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
        lists = pa.ListArray.from_arrays(offsets, pa.array(values, pa.int32()), mask=pa.array(nulls))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), lists, pa.array(sizes), pa.array(same, pa.bool_()), *batch.columns[3:]],
            [id_column, "ids", "n_ids", "lossless", *kept],
        )

    kind = dict(docs.dtypes)[id_column]
    key = column(docs, id_column)
    stream = F.coalesce(key.cast("long") if kind in ("bigint", "int") else F.xxhash64(key), F.lit(0))
    schema = T.StructType.fromDDL(f"{id_column} {kind}, ids array<int>, n_ids long, lossless boolean")
    schema = T.StructType([*schema.fields, *[docs.schema[c] for c in kept]])
    return docs.select(
        key.alias("id"),
        stream.cast("long").alias("stream"),
        column(docs, text).alias("text"),
        *[column(docs, c) for c in kept],
    ).mapInArrow(batches(run), schema)


def decode(encoded: DataFrame, model: str = MODEL, ids: str = "ids", out: str = "text") -> DataFrame:
    """Add the text that ``ids`` stand for, in place of a column of this name; null for null."""
    kept = [c for c in encoded.columns if c.lower() != out.lower()]

    def run(batch):
        book = pieces(model)
        texts = [None if x is None else book.decode(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(texts, pa.string())], [*batch.schema.names[:-1], out]
        )

    taken = encoded.select(*[column(encoded, c) for c in kept], column(encoded, ids).alias("_ids"))
    schema = T.StructType([*taken.drop("_ids").schema.fields, T.StructField(out, T.StringType())])
    return taken.mapInArrow(batches(run), schema)


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"))

import random
from collections import Counter

import pyarrow as pa

from offhours.llm.line_dedup import Chunks, dedup_lines, op5_line_dedup
from tests.llm.edges import documents, no_documents


def pieces_of(text):
    """Chunks of a text as tuples of lines, by the operator's own cuts."""
    chunks = Chunks(pa.array([text]))
    lines = text.split("\n")
    return [tuple(lines[a:b]) for a, b in zip(chunks.starts, chunks.stops)]


def lines(seed, n):
    pick = random.Random(seed)
    return [" ".join(f"{seed}w{pick.randrange(10**6)}" for _ in range(4)) for _ in range(n)]


def test_chunks_cover_the_text():
    for text in ("", "a", "a\nb", "\n\n\n", "\n".join(lines(1, 50)) + "\n"):
        assert [x for c in pieces_of(text) for x in c] == text.split("\n")


def test_cuts_resist_shifts():
    passage = lines(2, 40)
    plain = set(pieces_of("\n".join(passage)))
    for start in range(1, 4):
        moved = lines(3, start) + passage[:20] + ["one more line"] + passage[20:]
        assert len(plain & set(pieces_of("\n".join(moved)))) >= len(plain) - 4


def plain_dedup(rows):
    """Texts without chunks of several lines whose lines stand elsewhere before."""
    places = Counter()
    chunks = [pieces_of(t) if t else [] for _, t in rows]
    for found in chunks:
        places.update(c for c in found if len(c) > 1 and any(x.strip() for x in c))
    return places, chunks


def test_repeated_passages_go(spark):
    shared, rows = lines(5, 12), []
    for i in range(30):
        rows.append((i, "\n".join(lines(100 + i, 3) + shared + lines(200 + i, 3)), "en", "a"))
    docs = documents(spark, rows)
    found = {r["doc_id"]: r for r in dedup_lines(docs).collect()}
    places, chunks = plain_dedup([(i, t) for i, t, _, _ in rows])
    left = Counter()
    for (i, text, _, _), cut in zip(rows, chunks):
        r, kept = found[i], []
        gone = {n for pair in r["cut"]["removed"] for n in range(pair["first"], pair["last"] + 1)}
        kept = [x for n, x in enumerate(text.split("\n")) if n not in gone]
        assert r["text"] == "\n".join(kept) and r["n_chars"] == len(r["text"])
        at = 0
        for c in cut:
            if places[c] > 1:
                removed = set(range(at, at + len(c))) <= gone
                left[c] += not removed
                assert removed or not gone & set(range(at, at + len(c)))
            else:
                assert not gone & set(range(at, at + len(c)))
            at += len(c)
    repeated = {c for c, n in places.items() if n > 1}
    assert repeated and all(left[c] == 1 for c in repeated)
    assert found[0]["cut"]["n_removed"] == 0  # the first place keeps its lines
    assert sum(r["cut"]["n_removed"] for r in found.values()) > 29 * 5


def test_round_trip_on_given_texts(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op5_line_dedup(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        gone = {n for p in r["removed"] for n in range(p["first"], p["last"] + 1)}
        kept = [x for n, x in enumerate(texts[r["doc_id"]].split("\n")) if n not in gone]
        assert r["text"] == "\n".join(kept) and r["n_removed"] == len(gone)


def test_edges(spark):
    docs = documents(spark)
    found = dedup_lines(docs)
    assert found.columns == [*docs.columns, "cut"] and found.count() == docs.count()
    texts = Counter((r["doc_id"], r["text"]) for r in found.collect())
    first = docs.where("doc_id = 1").first()["text"]
    assert texts[1, first] == 1 and texts[2, first] == 0  # the copy loses what the first keeps
    assert texts[3, None] == 1 and texts[4, ""] == 1 and texts[6, "solo"] == 2
    twice = documents(spark, [(1, first, "en", "a")] * 2)
    assert {r["text"] for r in dedup_lines(twice).collect()} == {first}
    assert dedup_lines(no_documents(spark)).count() == 0


def plain_runs(rows):
    """Lines of each text in runs of two or more, blanks aside, that stand elsewhere before."""
    first, gone = {}, {}
    for i, text in sorted(rows):
        solid = [(n, x) for n, x in enumerate(text.split("\n")) if x.strip()]
        gone[i] = set()
        for (a, x), (b, y) in zip(solid, solid[1:]):
            if first.setdefault((x, y), (i, a)) != (i, a):
                gone[i] |= set(range(a, b + 1))
    return gone


def test_short_passages_go_whole_and_long_ones_with_their_edges(spark):
    pick, rows = random.Random(4), []
    passages = [lines(500 + n, n % 6 + 2) for n in range(24)] + [lines(600, 40)]
    for i in range(75):
        shared = list(passages[i % 25])
        if i % 2:  # a blank line inside changes nothing
            shared.insert(1, "")
        text = lines(1000 + i, pick.randrange(1, 6)) + shared + lines(2000 + i, pick.randrange(1, 6))
        rows.append((i, "\n".join(text), "en", "a"))
    rows.append((80, rows[0][1].split("\n")[0] + "\nits first line alone is repeated", "en", "a"))
    expected = plain_runs([r[:2] for r in rows])
    for r in dedup_lines(documents(spark, rows), grow=True).collect():
        gone = {n for p in r["cut"]["removed"] for n in range(p["first"], p["last"] + 1)}
        own = rows[r["doc_id"] if r["doc_id"] < 75 else 75][1].split("\n")
        kept = [x for n, x in enumerate(own) if n not in gone]
        assert r["text"] == "\n".join(kept) and r["cut"]["n_removed"] == len(gone)
        # Chunks may end in blank lines; else it is the runs exactly.
        assert {n for n in gone if own[n]} == {n for n in expected[r["doc_id"]] if own[n]}
        if 25 <= r["doc_id"] < 75:
            assert not set(passages[r["doc_id"] % 25]) & set(kept)
        else:
            assert not gone


def test_registered_query_leaves_no_repeated_run(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    expected = plain_runs([(i, t) for i, t in texts.items() if t])
    found = {r["doc_id"]: r for r in op5_line_dedup(spark, sf).collect()}
    for i, runs in expected.items():
        gone = {n for p in found[i]["removed"] for n in range(p["first"], p["last"] + 1)}
        assert runs <= gone
    assert any(expected.values())
    # The first place of every line stays.
    kept = {x for r in found.values() for x in (r["text"] or "").split("\n")}
    assert {x for t in texts.values() if t for x in t.split("\n") if x.strip()} <= kept

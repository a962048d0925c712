import re
from fractions import Fraction
from itertools import permutations

from pyspark.sql import functions as F

from offhours.llm import filter_audit as fa
from tests.llm import edges

LABELS = "doc_id long, quality int, toxic int, score string"


def fails(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    found = ""
    found += "A" if len(words) < 200 else ""
    found += "B" if 100 * len(set(words)) < 50 * len(words) else ""
    found += "C" if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else ""
    found += "D" if re.search("[#$%&*|]", text) else ""
    return found


def brute_force(docs, labels):
    """Every order over every document."""
    least, good, toxic = {}, set(), set()
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    for i, quality, bad, *_ in labels:
        good |= {i} if quality == 1 and i is not None else set()
        toxic |= {i} if bad == 1 and i is not None else set()
    parts = {}
    for i, text, source in docs:
        copy = i is not None and least[text or ""] < i
        row = (fails(text) + ("E" if copy else ""), i in good, i in toxic)
        parts.setdefault(source or "", []).append(row)
    out = {}
    for part, rows in parts.items():
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[0]]
                left = [r for r in left if f not in r[0]]
                total[f] += len(gone)
                out[part, order, step] = [
                    len(left),
                    len(gone),
                    sum(f in r[0] for r in rows) - len(gone),
                    sum(f == r[0] for r in rows),
                    sum(r[1] for r in gone),
                    sum(r[2] for r in gone),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def rows_of(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r["part"], r["filter_order"], r["step"]): tuple(r[n] for n in names) for r in df.collect()}


def test_equals_all_orders_run_over_the_documents(spark):
    many = " ".join(f"w{i}" for i in range(220))
    rows = [*edges.ROWS, *[(i, many, "en", "a") for i in (20, 21, 22)]]
    rows += [(23, many + " A" * 300, "en", "a"), (24, "x# " * 250, "en", "b"), (19, many, "en", "c")]
    rows += [(25, None, "en", "b"), (25, "", "en", "b"), (26, "\x0b\x0c a\x1c b", "en", "b")]
    labels = [(20, 1, 0, "s"), (21, 0, 1, "s"), (22, None, 1, "s"), (22, 1, None, "s"), (None, 1, 1, "s"),
              (1, 1, 1, "s"), (2, 1, 0, "s"), (2, 0, 1, "s"), (24, 1, 0, "s"), (999, 1, 1, "s")]
    found = rows_of(fa.audit(edges.documents(spark, rows), spark.createDataFrame(labels, LABELS)))
    assert found == brute_force([(i, t, s) for i, t, _, s in rows], labels)


def test_no_documents_and_no_labels(spark):
    none = spark.createDataFrame([], LABELS)
    assert fa.audit(edges.no_documents(spark), none).count() == 0
    found = rows_of(fa.audit(edges.documents(spark), none))
    assert found == brute_force([(i, t, s) for i, t, _, s in edges.ROWS], [])


def test_potentials_are_exact_and_add_up(spark):
    """The recursion against sums over subsets, on a game that is no count of documents."""
    worth = [0] + [(s * 7919) % 101 for s in range(1, 32)]
    df = spark.range(1).select(F.array(*[F.lit(w).cast("long") for w in worth]).alias("w"))
    found = df.select(fa.potentials(F.col("w")).alias("p")).first()["p"]

    def dividend(s):
        inside = [t for t in range(32) if t & s == t]
        return sum((-1) ** (bin(s).count("1") - bin(t).count("1")) * worth[t] for t in inside)

    for s in range(32):
        subsets = [t for t in range(1, 32) if t & s == t]
        assert found[s] == 60 * sum(Fraction(dividend(t), bin(t).count("1")) for t in subsets)
    shapley = [found[31] - found[31 - (1 << i)] for i in range(5)]
    assert sum(shapley) == 60 * worth[31]

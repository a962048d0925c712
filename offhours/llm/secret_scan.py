"""Secret scans over a ledger of blobs.

Every version of every file is addressed by the SHA-256 of its text. The ledger
holds one row per (blob, rule version) that was ever scanned, with its findings,
also when there are none. A run scans only pairs that the ledger lacks and joins
the findings back to all paths that hold a blob.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offhours.llm.shared import batches, column, sieve, sifted, stored, table

# The base rules, in the order in which equal starts are listed.
BASE = {
    "assign": (
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE,
    ),
    "access": (r"AKIA[A-Z0-9]+", re.ASCII),
    "hex": (r"[0-9a-f]+", re.ASCII),
}
LEAST = {"assign": 12, "access": 18, "hex": 16}

# What the base rules lack: formats that are secrets by themselves.
MORE = {
    "private_key": r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----",
    "github": r"gh[oprsu]_[A-Za-z0-9]{36,}",
    "slack": r"xox[abprs]-[A-Za-z0-9-]{10,}",
    "jwt": r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
}
KINDS = [*BASE, *MORE]
RULES = hashlib.sha256(repr((BASE, LEAST, MORE)).encode()).hexdigest()[:16]
FINDINGS = "array<struct<kind:string,start:int,end:int>>"

_ASSIGN = re.compile(*BASE["assign"])
# A run shorter than the least length cannot hide a longer one, so for these two
# the length may stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}", re.ASCII)
_HEX = re.compile(r"[0-9a-f]{16,}", re.ASCII)
_MORE = {kind: re.compile(p, re.ASCII) for kind, p in MORE.items()}
_HINTS = {"private_key": "PRIVATE KEY", "github": "gh", "slack": "xox", "jwt": "eyJ"}


def scan(text: str) -> list[tuple[str, int, int]]:
    """Findings (kind, start, end) of a text in code points, by start, then kind as listed."""
    low = text.lower()
    found = []
    if any(word in low for word in ("passw", "secret", "token", "api")):
        for m in _ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= LEAST["assign"]:
                found.append((m.start(), 0, m.end()))
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    for place, (kind, pattern) in enumerate(_MORE.items(), len(BASE)):
        if _HINTS[kind] in text:
            found += [(m.start(), place, m.end()) for m in pattern.finditer(text)]
    return [(KINDS[k], start, end) for start, k, end in sorted(found)]


_STRUCT = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _scan_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [
        [{"kind": k, "start": s, "end": e} for k, s, e in scan(text)]
        for text in batch.column(1).to_pylist()
    ]
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(found, _STRUCT)], ["blob", "findings"]
    )


def addressed(versions: DataFrame, text: str = "text") -> DataFrame:
    """Add nothing but ``blob``: the content address; a null text is the empty one."""
    content = F.coalesce(column(versions, text), F.lit(""))
    return versions.withColumn("blob", F.sha2(content.cast("binary"), 256)).withColumn("text", content)


def scan_unseen(versions: DataFrame, ledger: DataFrame | None = None) -> DataFrame:
    """New ledger rows (``blob``, ``rules``, ``findings``) for ``versions`` (``blob``, ``text``).

    Only addresses are counted to find blobs that occur more than once or are in
    the ledger. A text whose blob occurs once and is new is scanned where it
    lies; the others are first brought together by blob, map-side first, and
    checked against the ledger. The sieve that parts them has a bounded size and
    may only send too many the long way.
    """
    key = F.xxhash64("blob").alias("key")
    often = versions.groupBy("blob").count().where(F.col("count") > 1).select(key)
    if ledger is not None:
        ledger = ledger.where(F.col("rules") == RULES).select("blob")
        often = often.union(ledger.select(key))
    parted = sifted(versions.withColumn("key", key), "key", sieve(often, "key"), "often")
    alone = parted.where(~F.col("often")).select("blob", "text")
    together = parted.where("often").groupBy("blob").agg(F.max("text").alias("text"))
    if ledger is not None:
        together = together.join(ledger, "blob", "left_anti")
    return (
        alone.union(together)
        .mapInArrow(batches(_scan_batch), f"blob string, findings {FINDINGS}")
        .select("blob", F.lit(RULES).alias("rules"), "findings")
    )


def secrets(
    versions: DataFrame, ledger: DataFrame | None = None, text: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """(every row of ``versions`` with its ``findings``, the ledger as it is now).

    ``ledger`` is what an earlier call returned, or None. The new ledger is
    written to the shared folder once and both results read it. Rows keep their
    number and columns, less ``text``; ``blob`` and ``findings`` are added, in
    place of columns of these names. Null and empty texts are one blob without
    findings; an empty table gives an empty result.
    """
    rows = addressed(versions, text)
    new = stored(scan_unseen(rows.select("blob", "text"), ledger), "ledger")
    whole = new if ledger is None else ledger.unionByName(new)
    hits = whole.where((F.col("rules") == RULES) & (F.size("findings") > 0))
    kept = [c for c in rows.columns if c not in ("text", text, "findings")]
    found = rows.select(*[column(rows, c) for c in kept]).join(
        hits.select("blob", "findings"), "blob", "left"
    )
    return found.withColumn("findings", F.coalesce("findings", F.array().cast(FINDINGS))), whole


def listed(findings) -> Column:
    """kind:start:end of all findings, comma-joined in their order."""
    return F.array_join(
        F.transform(
            findings,
            lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string")),
        ),
        ",",
    )


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = secrets(table(spark, sf_dir, "documents").select("doc_id", "text"))
    kinds = [F.lit(k) for k in BASE]
    base = F.filter("findings", lambda f: f["kind"].isin(*kinds))

    def count(kind):
        return F.size(F.filter("findings", lambda f: f["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in BASE],
        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("findings")).alias("spans"),
    )

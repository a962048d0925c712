"""Document sink with an account of what was written and what was refused."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offhours.functions.moments import finite_or_null
from offhours.plans.serving import as_json, to_documents, with_document_id
from offhours.schemas import DOCUMENTS
from offhours.session import observed


@dataclass
class WriteAccount:
    """Outcome of a document write; ``examples`` holds the first few refused documents."""

    success: int = 0
    errors: int = 0
    examples: list[str] = field(default_factory=list)


def refused(gold: DataFrame) -> Column:
    """True for a row that its document cannot represent.

    That is a row without a timestamp, or with a value that the mapped type
    cannot hold although it is neither null nor NaN; a finite number that a float
    cannot hold is one.
    """
    have = dict(gold.dtypes)
    bad = F.col("Datetime").isNull()
    for f in DOCUMENTS:
        if f.name not in have or isinstance(f.dataType, T.StringType):
            continue
        value = F.col(f.name)
        if isinstance(f.dataType, T.FloatType):
            if have[f.name] == "double":
                bad = bad | F.coalesce(
                    finite_or_null(value).isNotNull() & finite_or_null(value.cast("float")).isNull(),
                    F.lit(False),
                )
            continue
        present = value.isNotNull()
        if have[f.name] in ("float", "double"):
            present = present & ~F.isnan(value)
        bad = bad | (present & value.try_cast(f.dataType).isNull())
    return bad


def accounts(gold: DataFrame) -> DataFrame:
    """One row: documents that can be written, and refused ones."""
    return gold.select(refused(gold).alias("_bad")).agg(
        F.count_if(~F.col("_bad")).alias("success"), F.count_if("_bad").alias("errors")
    )


def write_documents(gold: DataFrame, path: str, rejects_path: str | None = None) -> WriteAccount:
    """Write one JSON document per row, spread over as many files as there are tasks.

    The counts come along with the write. Refused rows go to ``rejects_path``
    when given; the rest is written regardless.
    """
    seen = Observation("documents")
    bad = refused(gold)
    flagged = gold.withColumn("_bad", bad).observe(
        seen, F.count_if(~F.col("_bad")).alias("success"), F.count_if("_bad").alias("errors")
    )
    documents = with_document_id(to_documents(flagged.where(~F.col("_bad")).drop("_bad")))
    as_json(documents).select(
        F.to_json(F.struct("_id", "_source")).alias("value")
    ).write.mode("overwrite").text(path)
    counts = observed(seen)
    account = WriteAccount(counts.get("success", 0), counts.get("errors", 0))
    if account.errors:
        rejects = gold.where(bad)
        if rejects_path:
            rejects.write.mode("overwrite").parquet(rejects_path)
            rejects = gold.sparkSession.read.parquet(rejects_path)
        account.examples = [r[0] for r in rejects.select(F.to_json(F.struct("*"))).limit(5).collect()]
    return account

"""Lineage chains with deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Steps that a chain lists unless told otherwise.
STEPS = ["pydantic_schema_validation", "boilerplate_removal"]


def record_id(kind: Column, url: Column, run_id: str) -> Column:
    return F.sha2(F.concat_ws("|", kind, url, F.lit(run_id)).cast("binary"), 256)


def chains(records: DataFrame, run_id: str, kind: str = "record_type", url: str = "source_url", status: str | None = None) -> DataFrame:
    """records with record_id, dedup_key, transformations, record_version and validation_status, which is taken from the column
    `status`, the outcome of a validation; without one the records count as not validated."""
    return records.withColumns(
        {
            "record_id": record_id(F.col(kind), F.col(url), run_id),
            "dedup_key": F.concat_ws(":", kind, url),
            "transformations": F.array(*map(F.lit, STEPS)),
            "record_version": F.lit(1),
            "validation_status": F.col(status) if status else F.lit("NOT_VALIDATED"),
        }
    )


def latest(log: DataFrame, seq: str = "seq") -> DataFrame:
    """The last chain written for each record."""
    return log.groupBy("record_id").agg(F.max_by(F.struct(*log.columns), seq).alias("c")).select("c.*")

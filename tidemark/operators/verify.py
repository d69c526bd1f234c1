"""Cross-source verification of field values, and the quality flags that disputes raise."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def verify_fields(observations: DataFrame, seq: str = "seq") -> DataFrame:
    """A verdict per (entity, field) of observations (entity, field, value, seq), grouped without regard to case.

    Values are grouped by their normalised text first, so a value that most sources state is one row."""
    obs = observations.select(F.lower(F.trim("entity")).alias("entity"), F.lower(F.trim("field")).alias("field"), "value", F.lower(F.trim(F.col("value").cast("string"))).alias("v"), F.col(seq).alias("s"))
    by_value = obs.groupBy("entity", "field", "v").agg(F.min("s").alias("s"), F.min_by("value", "s").alias("value"), F.count("*").alias("n"))
    present = F.col("v").isNotNull()
    groups = by_value.groupBy("entity", "field").agg(
        F.sum("n").alias("observations"),
        F.sum(F.when(present, F.col("n")).otherwise(0)).alias("non_null"),
        F.count_if(present).alias("distinct_values"),
        F.min_by(F.when(present, F.col("value")), F.when(present, F.col("s"))).alias("canonical"),
    )
    # flags need the first two distinct values; the limit on the place holds before the shuffle, so a task sees two for each part
    place = F.row_number().over(Window.partitionBy("entity", "field").orderBy("s"))
    first = by_value.where(present).withColumn("place", place).where("place <= 2").groupBy(F.col("entity").alias("_e"), F.col("field").alias("_f")).agg(F.array_sort(F.collect_list(F.struct("s", "value", "n"))).alias("groups"))
    groups = groups.join(first, F.col("entity").eqNullSafe(F.col("_e")) & F.col("field").eqNullSafe(F.col("_f")), "left").drop("_e", "_f")
    groups = groups.withColumn("groups", F.coalesce("groups", F.array()))
    status = F.when(F.col("non_null") <= 1, "SINGLE_SOURCE").when(F.col("distinct_values") == 1, "VERIFIED").otherwise("DISPUTED")
    confidence = F.when(F.col("non_null") == 0, 0.5).when(F.col("non_null") == 1, 0.75).when(F.col("distinct_values") == 1, 1.0).otherwise(0.45)
    return groups.withColumns({"status": status, "confidence": confidence})


def quality_flags(verdicts: DataFrame) -> DataFrame:
    """A flag per dispute: the first distinct value is expected, the second one is actual."""
    return verdicts.where("status = 'DISPUTED'").select("entity", "field", F.lit("disputed_value").alias("flag_type"), F.expr("groups[0].value").alias("expected"), F.expr("groups[1].value").alias("actual"), F.lit(45.0).alias("quality_score"), F.lit("DISPUTED").alias("status"))

"""Consumer groups over a queue folder: offsets of their own, redelivery, dead letters and their replay.

The queue is a folder of Parquet files that producers append to. A group is a streaming query with a checkpoint of its own, so
groups read independently. A batch is its new records and all that the batch before left to be tried again; it is handled
at once, and every record becomes done, a retry or a dead letter. Each of the three tables gets a partition of the batch, so a
batch that is repeated after a crash replaces what it wrote. Handling is at least once, results are exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.streaming.jobs import stream_table

#: Tries of a record.
TRIES = 3


class Group:
    """A consumer group. handle takes records and gives them back with a column `error`, null where all went well; it must keep the
    other columns."""

    def __init__(self, spark: SparkSession, queue: str, schema: str, name: str, folder: str, handle: Callable[[DataFrame], DataFrame], tries: int = TRIES):
        self.spark, self.queue, self.schema, self.handle, self.tries = spark, queue, schema, handle, tries
        self.folder = f"{folder}/{name}"
        self.waiting = f"{schema}, tries int"
        self.failed = f"{schema}, tries int, error string"

    def run(self) -> None:
        """Handle what is in the queue and stop; what failed waits for the next batch or for `retry`."""
        stream = stream_table(self.spark, self.queue, self.schema)
        query = stream.writeStream.foreachBatch(lambda rows, n: self._batch(rows, n)).option("checkpointLocation", f"{self.folder}/offsets").trigger(availableNow=True).start()
        query.awaitTermination()

    def retry(self) -> bool:
        """Try once more what waits, without new records; whether anything still waits."""
        at = self._last()
        if at is not None and not self._table("retry", self.waiting, at).isEmpty():
            self._step(self._table("retry", self.waiting, at), (at[0], at[1] + 1))
            at = (at[0], at[1] + 1)
        return at is not None and not self._table("retry", self.waiting, at).isEmpty()

    def replay(self) -> None:
        """All dead letters wait again, with no tries counted; they are dead letters no longer."""
        dead, at = self.dead(), self._last()
        if at is None:
            return
        again = dead.drop("error").withColumn("tries", F.lit(0)).unionByName(self._table("retry", self.waiting, at))
        after = (at[0], at[1] + 1)
        self._write("replayed", dead.limit(0), after)  # dead letters up to here have been replayed, once the retries are there
        self._write("retry", again, after)

    def done(self) -> DataFrame:
        return self._table("done", f"{self.schema}, tries int")

    def dead(self) -> DataFrame:
        """The dead letters since the last replay, with the last error."""
        since, last = self._steps("replayed"), self._last()
        since = [x for x in since if last is not None and x <= last]  # a replay that broke off does not count
        rows = self._table("dead", self.failed, keep=True)
        if since:
            rows = rows.where(F.struct("batch", "round") > F.struct(F.lit(since[-1][0]).cast("long"), F.lit(since[-1][1])))
        return rows.drop("batch", "round")

    def _batch(self, rows: DataFrame, number: int) -> None:
        at = self._last(before=number)
        fresh = rows.withColumn("tries", F.lit(0))
        self._step(fresh if at is None else fresh.unionByName(self._table("retry", self.waiting, at)), (number, 0))

    def _step(self, rows: DataFrame, at: tuple[int, int]) -> None:
        handled = self.handle(rows).withColumn("tries", F.col("tries") + 1).persist()
        try:
            self._write("done", handled.where("error IS NULL").drop("error"), at)
            self._write("dead", handled.where((F.col("error").isNotNull()) & (F.col("tries") >= self.tries)), at)
            # the retries come last: a step counts once they are there
            self._write("retry", handled.where((F.col("error").isNotNull()) & (F.col("tries") < self.tries)).drop("error"), at)
        finally:
            handled.unpersist()

    def _write(self, table: str, rows: DataFrame, at: tuple[int, int]) -> None:
        rows.write.mode("overwrite").parquet(f"{self.folder}/{table}/batch={at[0]}/round={at[1]}")

    def _table(self, table: str, schema: str, at: tuple[int, int] | None = None, keep: bool = False) -> DataFrame:
        """A table, or one step of it. Steps that broke off before their retries were written are left out."""
        if at is not None:
            return self.spark.read.schema(schema).parquet(f"{self.folder}/{table}/batch={at[0]}/round={at[1]}")
        steps = set(self._steps("retry"))
        paths = [f"{self.folder}/{table}/batch={b}/round={r}" for b, r in self._steps(table) if (b, r) in steps]
        wide = f"{schema}, batch long, round int"
        rows = self.spark.read.schema(wide).option("basePath", f"{self.folder}/{table}").parquet(*paths) if paths else self.spark.createDataFrame([], wide)
        return rows if keep else rows.drop("batch", "round")

    def _steps(self, table: str) -> list[tuple[int, int]]:
        """The finished steps of a table, in order."""
        context = self.spark.sparkContext
        root = context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}")
        found = root.getFileSystem(context._jsc.hadoopConfiguration()).globStatus(context._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{table}/batch=*/round=*/_SUCCESS"))
        places = [str(x.getPath().getParent()) for x in found or []]
        return sorted((int(p.rsplit("batch=", 1)[1].split("/")[0]), int(p.rsplit("round=", 1)[1])) for p in places)

    def _last(self, before: int | None = None) -> tuple[int, int] | None:
        steps = [s for s in self._steps("retry") if before is None or s[0] < before]
        return steps[-1] if steps else None

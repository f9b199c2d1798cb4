"""All-zones runs that commit zone by zone and can be taken up again.

Every step computes its pending zones in one job and replaces their partitions; a manifest
row per zone and step is written after that. A zone whose step leaves no row, or whose job
fails, stops there, the others go on: a failed job is halved by a hash of the zone until the
zones that fail stand alone. A restart leaves out what the manifest has as done; a step whose
data was written but not entered is computed again and replaces its own partitions, so a run
stopped anywhere and resumed equals an undisturbed one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from terracover.sources.staging import stage

MANIFEST = "zone {zone}, step string, status string, n_rows bigint, message string, entry timestamp"
DONE, FAILED = "success", "error"
# Halvings of a failed job before its zones are given up together.
MOST_HALVINGS = 40

Step = Callable[[DataFrame], DataFrame]


class ZoneRun:
    """Steps over zones below one folder: ``<root>/<step>/zone=…`` and ``<root>/manifest``."""

    def __init__(self, spark: SparkSession, root: str, zone_type: str = "int"):
        self.spark, self.root = spark, root.rstrip("/")
        self.schema = MANIFEST.format(zone=zone_type)
        spark.createDataFrame([], self.schema).write.mode("ignore").parquet(f"{self.root}/manifest")

    def path(self, step: str) -> str:
        return f"{self.root}/{step}"

    def output(self, step: str, zones: DataFrame | None = None) -> DataFrame:
        """Rows of a step, of the given zones if asked."""
        zone = self.schema.split(",")[0]
        table = self.spark.read.parquet(self.path(step))
        table = table.withColumn("zone", F.col("zone").cast(zone.split(" ")[1]))
        return table if zones is None else table.join(zones.select("zone"), "zone", "left_semi")

    def manifest(self) -> DataFrame:
        """Last entry of every zone and step."""
        entries = self.spark.read.schema(self.schema).parquet(f"{self.root}/manifest")
        latest = Window.partitionBy("zone", "step").orderBy(F.col("entry").desc(), F.col("status").desc())
        return entries.withColumn("k", F.row_number().over(latest)).where("k = 1").drop("k")

    def _enter(self, rows: DataFrame) -> None:
        names = [f.split()[0] for f in self.schema.split(", ")]
        rows.withColumn("entry", F.current_timestamp()).select(*names).write.mode("append").parquet(f"{self.root}/manifest")

    def _write(self, name: str, step: Step, zones: DataFrame) -> None:
        rows = step(zones).repartitionByRange("zone", "r", "c")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("zone").parquet(self.path(name))

    def _commit(self, name: str, step: Step, zones: DataFrame, halvings: int = 0) -> None:
        """Compute, replace and enter the zones; halve them if the job fails."""
        if zones.isEmpty():
            return
        try:
            self._write(name, step, zones)
        except PySparkException as error:
            if halvings < MOST_HALVINGS and zones.limit(2).count() > 1:
                half = F.pmod(F.shiftright(F.xxhash64("zone"), halvings), F.lit(2))
                for side in (0, 1):
                    self._commit(name, step, zones.where(half == side), halvings + 1)
            else:
                message = str(error).strip().splitlines()[0][:500]
                self._enter(zones.select("zone", F.lit(name).alias("step"), F.lit(FAILED).alias("status"),
                                         F.lit(0).cast("bigint").alias("n_rows"), F.lit(message).alias("message")))
            return
        counts = self.output(name, zones).groupBy("zone").agg(F.count(F.lit(1)).alias("rows"))
        met = zones.join(counts, "zone", "left")
        self._enter(met.select(
            "zone", F.lit(name).alias("step"), F.when(F.col("rows") > 0, DONE).otherwise(FAILED).alias("status"),
            F.coalesce("rows", F.lit(0)).cast("bigint").alias("n_rows"), F.when(F.col("rows").isNull(), "no rows").alias("message"),
        ))

    def run(self, expected: DataFrame, steps: dict[str, Step], retry_failed: bool = False) -> DataFrame:
        """Run the steps of the expected zones that are not done; the outcome, see :meth:`outcome`.

        A step is a function of its pending zones (one column) that returns their rows with
        ``zone``, ``r`` and ``c``. Zones stopped earlier stay stopped unless ``retry_failed``.
        """
        pending = stage(expected.select("zone").distinct(), "zones")
        for name, step in steps.items():
            entered = self.manifest().where(F.col("step") == name)
            done = entered.where(F.col("status") == DONE).select("zone")
            left = pending.join(done if retry_failed else entered.select("zone"), "zone", "left_anti")
            self._commit(name, step, stage(left, "pending"))
            passed = self.manifest().where((F.col("step") == name) & (F.col("status") == DONE)).select("zone")
            pending = stage(pending.join(passed, "zone", "left_semi"), "zones")
        return self.outcome(expected, list(steps))

    def outcome(self, expected: DataFrame, steps: list[str]) -> DataFrame:
        """Per zone: status, first step that failed, its message, and rows after each step."""
        entries = self.manifest()
        rows = [F.coalesce(F.max(F.when(F.col("step") == s, F.col("n_rows"))), F.lit(0)).alias(f"n_{s[3:]}") for s in steps]
        failed = F.min(F.when(F.col("status") == FAILED, F.struct("step", "message")))
        passed = F.count_if((F.col("step") == steps[-1]) & (F.col("status") == DONE))
        zones = entries.groupBy("zone").agg(failed.alias("failed"), passed.alias("passed"), *rows)
        met = expected.select("zone").distinct().join(zones, "zone", "left")
        return met.select(
            "zone", F.when(F.col("passed") > 0, DONE).otherwise(FAILED).alias("status"), F.col("failed.step").alias("failed_step"),
            F.col("failed.message").alias("message"), *(F.coalesce(f"n_{s[3:]}", F.lit(0)).cast("bigint").alias(f"n_{s[3:]}") for s in steps),
        )

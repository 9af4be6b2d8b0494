"""History of check results: every run's rows are kept, warnings can be read back, two runs compared."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators.quality import BLOCKING

SUBJECT = ["check", "subject"]


class CheckHistory:
    """An append-only table of check results: ``stage, run_id, recorded_at`` and the columns of a result.

    A run's rows are one folder, written once; the folder's name is the run, so a run that is recorded again
    after a failure replaces its own rows and no others.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def record(self, results: DataFrame, stage: str, run_id: str, recorded_at: str | None = None) -> None:
        """Keep the rows of one run. Run ids are compared as text: let later runs have greater ones."""
        at = F.lit(recorded_at).cast("timestamp") if recorded_at else F.current_timestamp()
        rows = results.select("*", at.alias("recorded_at"), F.lit(stage).alias("stage"), F.lit(run_id).alias("run_id"))
        rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "stage", "run_id").parquet(self.path)

    def read(self, stage: str | None = None) -> DataFrame:
        columns = "check string, subject string, observed bigint, expected bigint, severity string, passed boolean, " \
                  "recorded_at timestamp, stage string, run_id string"
        rows = self.spark.read.schema(columns).parquet(self.path)
        return rows if stage is None else rows.where(F.col("stage") == stage)

    def warnings(self, stage: str, run_id: str) -> DataFrame:
        """What did not pass in a run without stopping it."""
        return self.read(stage).where((F.col("run_id") == run_id) & ~F.coalesce("passed", F.lit(False))
                                      & ~F.col("severity").isin(*BLOCKING, "info"))

    def trend(self, stage: str) -> DataFrame:
        """Per check and subject: observed in the last two runs, the change, and what became of it.

        ``trend`` is new, gone, mended, broken, better, worse or same; "better" is nearer to what is expected
        (to 0, if nothing is).
        """
        rows = self.read(stage)
        runs = rows.select("run_id").distinct().orderBy(F.desc("run_id")).limit(2)
        first, last = (runs.agg(f("run_id").alias("run_id")) for f in (F.min, F.max))
        one_only = runs.count() < 2
        before = _of_run(rows.where(F.lit(not one_only)), first, "before")
        now = _of_run(rows, last, "now")
        both = before.join(now, (before["check_before"].eqNullSafe(now["check_now"]))
                           & before["subject_before"].eqNullSafe(now["subject_now"]), "full")
        off = lambda when: F.abs(F.col(f"observed_{when}") - F.coalesce(F.col(f"expected_{when}"), F.lit(0)))
        state = (F.when(F.col("check_before").isNull(), "new").when(F.col("check_now").isNull(), "gone")
                 .when(~F.col("passed_before") & F.col("passed_now"), "mended")
                 .when(F.col("passed_before") & ~F.col("passed_now"), "broken")
                 .when(off("now") < off("before"), "better").when(off("now") > off("before"), "worse").otherwise("same"))
        return both.select(
            *[F.coalesce(f"{c}_now", f"{c}_before").alias(c) for c in SUBJECT],
            F.coalesce("severity_now", "severity_before").alias("severity"), "observed_before", "observed_now",
            (F.col("observed_now") - F.col("observed_before")).alias("change"), state.alias("trend"))


def _of_run(rows: DataFrame, run: DataFrame, when: str) -> DataFrame:
    own = rows.join(F.broadcast(run), "run_id", "left_semi")  # one row
    names: list[Column] = [F.col(c).alias(f"{c}_{when}") for c in (*SUBJECT, "observed", "expected", "severity")]
    return own.select(*names, F.coalesce("passed", F.lit(False)).alias(f"passed_{when}"))

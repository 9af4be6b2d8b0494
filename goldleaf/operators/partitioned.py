"""Keyed tables in partitions by key hash: an upsert rewrites only the partitions that its keys fall into.

Matched keys are in the increment's partitions and nowhere else, so only those are read, merged and written
back, by Spark's dynamic partition overwrite; the files of all other partitions stay as they are. The write is
staged and moved into place when all its tasks have ended, so a job that fails before leaves the table as it
was. A driver that dies between two moves leaves partitions of both states; the same upsert run again mends it
(it is idempotent). One writer per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goldleaf.operators.schemas import SchemaMismatch, conformed, evolved
from goldleaf.operators.upsert import merge_rows

PARTITIONS = 64  # on a cluster: table bytes / a few GB
PART = "key_part"  # name of the partition folder column


class PartitionedTable:
    """A Parquet table at ``path`` with one row per key."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], partitions: int = PARTITIONS,
                 files_per_partition: int = 1):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.partitions, self.files = partitions, files_per_partition

    def _parted(self, df: DataFrame) -> DataFrame:
        part = F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in self.keys]), F.lit(self.partitions)).cast("int")
        return df.withColumn(PART, part)

    def _write(self, parted: DataFrame) -> None:
        """The given partitions in the place of their former files, in ``files`` files each."""
        dealt = parted.repartition(self.partitions * self.files, F.col(PART),
                                   F.pmod(F.hash(*self.keys), F.lit(self.files)))
        dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART).parquet(self.path)

    def create(self, df: DataFrame) -> None:
        self._write(self._parted(df))

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self.path).drop(PART)

    def upsert(self, source: DataFrame) -> list[int]:
        """Replace the rows of the source's keys, add its new keys. Returns the partitions that were rewritten.

        ``source`` is read twice: pass a stored increment. Its columns must be the table's, in types that fit
        them: partitions that are not rewritten keep their files, and so their schema.
        """
        table = self.spark.read.parquet(self.path)
        schema = table.drop(PART).schema
        if evolved(schema, source.schema, self.keys, "strict") != conformed(table.drop(PART), schema).schema:
            raise SchemaMismatch(f"the increment does not have the columns of {self.path}")
        parted = self._parted(conformed(source, schema))
        touched = sorted(r[PART] for r in parted.select(PART).distinct().collect())  # at most one row per partition
        if touched:
            self._write(merge_rows(table.where(F.col(PART).isin(touched)), parted, [*self.keys, PART]))
        return touched

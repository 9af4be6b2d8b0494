"""Warehouse sinks: several tables written aside first, then made visible together.

A sink's ``publish(frames)`` stages every frame, and only when all of them are completely written do the new
tables take the old ones' places. A failure before that leaves all old tables as they were and removes what
was staged. How the places are taken depends on the sink:

* :class:`FolderSink`: any file format; one commit row names the version of all tables (:class:`VersionedStore`).
* :class:`CatalogSink`: staged catalog tables, then one view per name is pointed at its new table; views that
  were already moved are moved back if a later one cannot be.
* :class:`JdbcSink`: staged tables in the database, then all drops and renames in one transaction.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from goldleaf.sources.lake import VersionedStore


def _in_parallel(spark: SparkSession, jobs: list[Callable[[], object]], workers: int = 8) -> None:
    """Run independent Spark jobs together; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(max_workers=max(1, min(workers, len(jobs)))) as pool:
        ended = [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]
    for job in ended:
        job.result()


class FolderSink:
    """Tables under one root in any ``DataFrameWriter`` format."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.store = VersionedStore(spark, root, fmt)

    def publish(self, frames: Mapping[str, DataFrame]) -> None:
        self.store.publish(frames)

    def read(self, table: str) -> DataFrame:
        return self.store.read(table)


class CatalogSink:
    """Tables of a catalog namespace; readers use the plain names, which are views of the newest tables."""

    def __init__(self, spark: SparkSession, namespace: str, fmt: str = "parquet"):
        self.spark, self.namespace, self.fmt = spark, namespace, fmt

    def _target(self, name: str) -> str | None:
        """The table that the view ``name`` shows now."""
        if not self.spark.catalog.tableExists(f"{self.namespace}.{name}"):
            return None
        return self.spark.sql(f"SHOW TBLPROPERTIES {self.namespace}.{name}").where("key = 'shows'").first()["value"]

    def _show(self, name: str, table: str) -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.namespace}.{name} TBLPROPERTIES ('shows' = '{table}') "
                       f"AS SELECT * FROM {table}")

    def publish(self, frames: Mapping[str, DataFrame]) -> None:
        run = uuid.uuid4().hex[:8]
        staged = {name: f"{self.namespace}.{name}__{run}" for name in frames}
        before = {name: self._target(name) for name in frames}
        moved = []
        try:
            _in_parallel(self.spark, [lambda n=name, df=df: df.write.format(self.fmt).saveAsTable(staged[n])
                                      for name, df in frames.items()])
            for name in frames:
                moved.append(name)
                self._show(name, staged[name])
        except Exception:
            for name in moved:
                if before[name]:
                    self._show(name, before[name])
                else:
                    self.spark.sql(f"DROP VIEW IF EXISTS {self.namespace}.{name}")
            for table in staged.values():
                self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            raise
        for table in filter(None, before.values()):
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def read(self, table: str) -> DataFrame:
        return self.spark.table(f"{self.namespace}.{table}")


class JdbcSink:
    """Tables of a relational database. ``rename`` is the database's statement that renames a table.

    The swap needs a database that rolls back data definitions (PostgreSQL and Derby do).
    """

    def __init__(self, spark: SparkSession, url: str, properties: Mapping[str, str] | None = None, batch_size: int = 10_000,
                 rename: str = "ALTER TABLE {old} RENAME TO {new}", writers: int = 8):
        self.spark, self.url, self.properties = spark, url, dict(properties or {})
        self.batch_size, self.rename, self.writers = batch_size, rename, writers

    def _options(self, df_io, table: str):
        return df_io.format("jdbc").options(url=self.url, dbtable=table, batchsize=self.batch_size, **self.properties)

    def _connection(self):
        jvm = self.spark._jvm
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        info = jvm.java.util.Properties()
        for k, v in self.properties.items():
            info.setProperty(k, v)
        return jvm.java.sql.DriverManager.getConnection(self.url, info)

    def _statements(self, statements: list[str]) -> None:
        """Run statements in one transaction, from the driver."""
        connection = self._connection()
        try:
            connection.setAutoCommit(False)
            statement = connection.createStatement()
            try:
                for sql in statements:
                    statement.executeUpdate(sql)
                connection.commit()
            except Exception:
                connection.rollback()
                raise
        finally:
            connection.close()

    def _exists(self, table: str) -> bool:
        connection = self._connection()
        try:
            connection.createStatement().executeQuery(f"SELECT 1 FROM {table} WHERE 1 = 0").close()
            return True
        except Py4JJavaError:
            return False
        finally:
            connection.close()

    def publish(self, frames: Mapping[str, DataFrame]) -> None:
        run = uuid.uuid4().hex[:8]
        staged = {name: f"{name}_s{run}" for name in frames}
        try:
            _in_parallel(self.spark, [lambda n=name, df=df: self._options(df.write, staged[n]).mode("errorifexists").save()
                                      for name, df in frames.items()], self.writers)
            swap = []
            for name, table in staged.items():
                if self._exists(name):
                    swap.append(f"DROP TABLE {name}")
                swap.append(self.rename.format(old=table, new=name))
            self._statements(swap)
        except Exception:
            left = [t for t in staged.values() if self._exists(t)]
            if left:
                self._statements([f"DROP TABLE {t}" for t in left])
            raise

    def read(self, table: str) -> DataFrame:
        return self._options(self.spark.read, table).load()

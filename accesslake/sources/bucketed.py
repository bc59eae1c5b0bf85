"""Tables of unique keys in files bucketed and sorted by key, so that joins of two of them on the key move no row."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from accesslake.sources import tables

#: Spark sorts buckets again unless it is told that each is one sorted file, which is how ``write`` leaves them.
SORTED_BUCKETS_CONF = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


@dataclass(frozen=True)
class BucketedTable:
    """Versions of a table below a folder. Each is one file for every bucket, sorted by key.

    The number of buckets is part of the path; tables that are joined take the same. The session's catalog holds no more than
    the definition of what lies at a path, which is made again where a session lacks it.
    """

    root: str
    key: str
    buckets: int = 256

    @property
    def path(self) -> str:
        return f"{self.root}/of={self.buckets}"

    def write(self, rows: DataFrame) -> DataFrame:
        """Store the next version and read it. ``rows`` may be computed from the current one; the only shuffle is here."""
        spark = rows.sparkSession
        number = max((int(n[1:]) for n in tables.child_names(spark, self.path) if n[:1] == "v" and n[1:].isdigit()), default=0) + 1
        where = f"{self.path}/v{number}"
        writer = rows.repartition(self.buckets, self.key).write.format("parquet").option("path", where)
        writer.bucketBy(self.buckets, self.key).sortBy(self.key).mode("errorifexists").saveAsTable(self._name(where))
        tables.write_text(spark, f"{where}/{tables.COMPLETE}", "")
        return self._table(spark, where, rows.schema)

    def read(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """The current version; empty when there is none yet."""
        version = tables.current_version(spark, self.path)
        if version is None:
            return spark.createDataFrame([], schema)
        return self._table(spark, f"{self.path}/v{version}", schema)

    def drop(self, spark: SparkSession) -> None:
        """Remove all versions and what the session's catalog knows of them."""
        for name in tables.child_names(spark, self.path):
            spark.sql(f"drop table if exists {self._name(f'{self.path}/{name}')}")
        tables.drop_path(spark, self.path)

    def _name(self, where: str) -> str:
        return "bucketed_" + hashlib.sha256(f"{where} {self.key}".encode()).hexdigest()[:32]

    def _table(self, spark: SparkSession, where: str, schema: T.StructType) -> DataFrame:
        name = self._name(where)
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
            key, place = _quoted(self.key), where.replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(
                f"create table {name} ({columns}) using parquet clustered by ({key}) sorted by ({key}) "
                f"into {self.buckets} buckets location '{place}'"
            )
        spark.conf.set(SORTED_BUCKETS_CONF, "true")
        return spark.table(name).select(*[f.name for f in schema])

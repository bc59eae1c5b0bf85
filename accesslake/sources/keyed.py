"""Tables of unique keys, stored in buckets of a hash of the key, so that a change costs what its keys' buckets hold."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accesslake.operators.joins import anti_join
from accesslake.session import scratch_path
from accesslake.sources import tables
from accesslake.sources.journal import Journal

BUCKET = "bucket"


@dataclass(frozen=True)
class KeyedTable:
    """A table below a store's root, one folder for each bucket.

    The number of buckets belongs to the table and is part of its path. Buckets are partitions: those that a batch has no key
    in are neither listed nor read nor written. Numbers of touched buckets are all that reaches the driver.
    """

    journal: Journal
    name: str
    key: str
    schema: T.StructType
    buckets: int = 256

    @property
    def table(self) -> str:
        return f"{self.name}/of={self.buckets}"

    @property
    def path(self) -> str:
        return f"{self.journal.root}/{self.table}"

    def bucket_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the keys of some rows."""
        found = rows.select(self.bucket_of(F.col(self.key)).alias(BUCKET)).distinct().collect()
        return sorted(r[BUCKET] for r in found)

    def read(self, spark: SparkSession, buckets: list[int] | None = None) -> DataFrame:
        """The table, or the rows of some buckets."""
        others = [n for n in tables.child_names(spark, f"{self.journal.root}/{self.name}") if n.startswith("of=")]
        if others and f"of={self.buckets}" not in others:
            raise ValueError(f"{self.name} is stored in {others[0]} buckets, not {self.buckets}")
        if not others or (buckets is not None and not buckets):
            return spark.createDataFrame([], self.schema)
        columns = [f.name for f in self.schema]
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        rows = spark.read.schema(schema).parquet(self.path)
        if buckets is not None and len(buckets) < self.buckets:
            rows = rows.filter(F.col(BUCKET).isin(buckets))
        return rows.select(*columns)

    def insert(self, rows: DataFrame) -> None:
        """Add the rows whose key is not there yet; keys of ``rows`` are unique.

        Of the touched buckets the keys are read, and only buckets that get a row are rewritten.
        """
        with self._stored(rows) as stored:
            known = self.read(rows.sparkSession, self.touched(stored)).select(self.key)
            self._change(anti_join(stored, known, [self.key], unique=True), None)

    def upsert(self, rows: DataFrame, gone: DataFrame | None = None) -> None:
        """Put rows in place of those of equal key, add the others, and remove the keys of ``gone``; keys of ``rows`` are unique."""
        with self._stored(rows) as stored:
            keys = stored.select(self.key)
            if gone is None:
                self._change(stored, keys)
            else:
                with self._stored(gone.select(self.key)) as removed:
                    self._change(stored, keys.unionByName(removed))

    def delete(self, keys: DataFrame) -> None:
        """Remove the rows of some keys."""
        self.upsert(keys.sparkSession.createDataFrame([], self.schema), keys)

    @contextmanager
    def _stored(self, rows: DataFrame) -> Iterator[DataFrame]:
        """Rows of a change as a table, as they are read several times and may be computed from the buckets they change."""
        spark = rows.sparkSession
        self.journal.finish(spark)
        path = scratch_path(spark, "change")
        rows.write.parquet(path)
        yield spark.read.schema(rows.schema).parquet(path)
        tables.drop_path(spark, path)

    def _change(self, added: DataFrame, removed: DataFrame | None) -> None:
        spark = added.sparkSession
        columns = [f.name for f in self.schema]
        buckets = self.touched(added if removed is None else removed)
        if not buckets:
            return
        old = self.read(spark, buckets)
        if removed is not None:
            old = anti_join(old, removed, [self.key])
        rows = old.select(*columns).unionByName(added.select(*columns)).withColumn(BUCKET, self.bucket_of(F.col(self.key)))
        self.journal.stage(rows, self.table, BUCKET, emptied=[] if removed is None else buckets)
        self.journal.finish(spark)

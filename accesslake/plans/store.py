"""Where a store keeps its tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from accesslake import schemas
from accesslake.operators.star import agent_additions, catalog_additions
from accesslake.sources import tables
from accesslake.sources.journal import Journal
from accesslake.sources.keyed import KeyedTable


@dataclass(frozen=True)
class Store:
    """Tables below one root folder.

    Dimensions are snapshots, written whole by every change, or with ``buckets`` tables in so many buckets of a hash
    of the key, of which a change reads and writes those it touches.
    """

    root: str
    buckets: int | None = None

    facts_table = "downloads"

    @property
    def catalog_path(self) -> str:
        return f"{self.root}/downloadable"

    @property
    def agents_path(self) -> str:
        return f"{self.root}/user_agents"

    @property
    def facts_path(self) -> str:
        return f"{self.root}/{self.facts_table}"

    @property
    def archive_path(self) -> str:
        return f"{self.root}/archive"

    @property
    def malformed_path(self) -> str:
        return f"{self.root}/malformed"

    @property
    def journal(self) -> Journal:
        return Journal(self.root)

    def recover(self, spark: SparkSession) -> None:
        """Finish the changes that a job before this one has staged."""
        self.journal.finish(spark)

    @property
    def catalog_buckets(self) -> KeyedTable:
        return KeyedTable(self.journal, "downloadable", "s3key", _nullable(schemas.DOWNLOADABLE), self.buckets)

    @property
    def agent_buckets(self) -> KeyedTable:
        return KeyedTable(self.journal, "user_agents", "user_agent", _nullable(schemas.USER_AGENTS), self.buckets)

    def catalog(self, spark: SparkSession) -> DataFrame:
        if self.buckets:
            return self.catalog_buckets.read(spark)
        return tables.read_snapshot(spark, self.catalog_path, _nullable(schemas.DOWNLOADABLE))

    def agents(self, spark: SparkSession) -> DataFrame:
        if self.buckets:
            return self.agent_buckets.read(spark)
        return tables.read_snapshot(spark, self.agents_path, _nullable(schemas.USER_AGENTS))

    def facts(self, spark: SparkSession) -> DataFrame:
        return tables.read_facts(spark, self.facts_path, _nullable(schemas.DOWNLOADS))

    def add_files(self, spark: SparkSession, downloads: DataFrame, collation: str | None = None) -> None:
        """Catalog rows for the keys of some downloads that have none."""
        if self.buckets:
            self.catalog_buckets.insert(catalog_additions(downloads, spark.createDataFrame([], "s3key string")))
        else:
            catalog = self.catalog(spark)
            tables.write_snapshot(catalog.unionByName(catalog_additions(downloads, catalog, collation)), self.catalog_path)

    def add_agents(self, spark: SparkSession, downloads: DataFrame, collation: str | None = None) -> None:
        """Rows for the user agents of some downloads that have none."""
        if self.buckets:
            self.agent_buckets.insert(agent_additions(downloads, spark.createDataFrame([], "user_agent string")))
        else:
            agents = self.agents(spark)
            tables.write_snapshot(agents.unionByName(agent_additions(downloads, agents, collation)), self.agents_path)

    def put_files(self, catalog: DataFrame, changed: DataFrame, gone: DataFrame | None = None) -> None:
        """Store a catalog of which the rows ``changed`` are new or other than before, and the keys ``gone`` are no longer there."""
        if self.buckets:
            self.catalog_buckets.upsert(changed, gone)
        else:
            tables.write_snapshot(catalog, self.catalog_path)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema])

"""A catalog held against a listing where both are stored in the same buckets of the key."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from accesslake.sources.bucketed import BucketedTable


@dataclass(frozen=True)
class CatalogSync:
    """Copies of a catalog and of listings for plans that are merge joins of sorted buckets.

    A listing is shuffled once, when it is put; the plan, the registration and both differences of a collection read it as it
    lies. Keys are unique on either side. At 1,000 million keys, 4,096 buckets are some 20 MB a task.
    """

    root: str
    buckets: int = 256

    @property
    def catalogs(self) -> BucketedTable:
        return BucketedTable(f"{self.root}/catalog", "s3key", self.buckets)

    @property
    def listings(self) -> BucketedTable:
        return BucketedTable(f"{self.root}/listing", "s3key", self.buckets)

    def put_catalog(self, catalog: DataFrame) -> DataFrame:
        return self.catalogs.write(catalog)

    def put_listing(self, listing: DataFrame) -> DataFrame:
        return self.listings.write(listing)

    def both(self, spark: SparkSession, catalog: T.StructType, listing: T.StructType) -> tuple[DataFrame, DataFrame]:
        """The current catalog and listing."""
        return self.catalogs.read(spark, catalog), self.listings.read(spark, listing)

"""Reports over downloads and the catalog; none carries an address or a user agent."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Trailing days per reporting period.
PERIODS = {"day": 1, "week": 7, "month": 30, "year": 365}

SIZE_CLASSES = (("under_1k", 1_000), ("under_10k", 10_000), ("under_1m", 1_000_000), ("under_1g", 1_000_000_000))


def popular_downloads(
    downloads: DataFrame, as_of, k: int = 10, periods: Mapping[str, int] = PERIODS
) -> DataFrame:
    """The ``k`` most downloaded keys of each period that ends with the day ``as_of``.

    Input columns: ``key``, ``day``, ``bytes_sent``. One aggregate serves all periods. The rank filter
    is pushed below the shuffle as a group limit, so a period's keys never meet in one task, only
    the best ``k`` of every task do.
    """
    end = F.lit(as_of).cast("date")
    longest = max(periods.values())
    within = {p: F.col("day") > F.date_sub(end, days) for p, days in periods.items()}
    aggs = []
    for period, inside in within.items():
        aggs.append(F.count_if(inside).alias(f"n_{period}"))
        aggs.append(F.coalesce(F.sum(F.when(inside, F.col("bytes_sent"))), F.lit(0)).alias(f"b_{period}"))
    per_key = (
        downloads.filter((F.col("day") <= end) & (F.col("day") > F.date_sub(end, longest)))
        .groupBy("key")
        .agg(*aggs)
    )
    long = per_key.select(
        "key",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(p).alias("period"), F.col(f"n_{p}").alias("n"), F.col(f"b_{p}").alias("bytes"))
                    for p in periods
                ]
            )
        ),
    ).filter(F.col("n") > 0)
    order = W.partitionBy("period").orderBy(F.desc("n"), F.asc("key"))
    return long.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def size_class(size: Column) -> Column:
    label = F.when(size.isNull(), F.lit("unknown"))
    for name, bound in SIZE_CLASSES:
        label = label.when(size < bound, F.lit(name))
    return label.otherwise(F.lit("1g_and_more"))


def downloads_by_size(downloads: DataFrame) -> DataFrame:
    """Downloads and bytes per size class of the file."""
    return downloads.groupBy(size_class(F.col("object_size")).alias("size_class")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes_sent").alias("bytes")
    )


def downloads_by_tag(downloads: DataFrame, tag: str) -> DataFrame:
    """Downloads and bytes per value of one tag in the JSON column ``tags``."""
    return downloads.groupBy(F.get_json_object("tags", f"$.{tag}").alias("tag")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("bytes_sent").alias("bytes")
    )


def export_catalog_json(catalog: DataFrame) -> DataFrame:
    """Every catalog row as one JSON object."""
    return catalog.select(F.to_json(F.struct(*catalog.columns)).alias("json"))

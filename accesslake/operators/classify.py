"""Record classes and the filters around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from accesslake import schemas
from accesslake.functions import text
from accesslake.operators.joins import anti_join


def nonblank_lines(lines: DataFrame) -> DataFrame:
    """Lines stripped at both ends, without those that are then empty."""
    return lines.withColumn("line", text.strip(F.col("line"))).filter(F.col("line") != "")


def filter_year(records: DataFrame, year: int | None) -> DataFrame:
    """Records whose time, as written in the line, lies in the year."""
    return records if year is None else records.filter(F.year("dtime_local") == year)


def drop_ignored_keys(records: DataFrame, ignored: DataFrame) -> DataFrame:
    """Records whose key is not in ``ignored.key``."""
    return anti_join(records, ignored, ["key"], check_size=True)


def record_class(operation: Column, http_status: Column) -> Column:
    """Class of a record; the families are tested in the order GET, WRITE, DELETE, MISC."""
    served = http_status.isNull() | http_status.isin(200, 206)
    return (
        F.when(
            operation.isin(*schemas.GET_OPERATIONS),
            F.when(served, F.lit(schemas.DOWNLOAD)).otherwise(F.lit(schemas.BAD)),
        )
        .when(
            operation.isin(*schemas.WRITE_OPERATIONS),
            F.when(http_status.between(400, 499), F.lit(schemas.BLOCKED)).otherwise(F.lit(schemas.UPLOAD)),
        )
        .when(operation.isin(*schemas.DELETE_OPERATIONS), F.lit(schemas.DELETED))
        .when(operation.isin(*schemas.MISC_OPERATIONS), F.lit(schemas.MISC))
        .otherwise(F.lit(schemas.UNKNOWN))
    )


def classify(records: DataFrame) -> DataFrame:
    return records.withColumn("class", record_class(F.col("operation"), F.col("http_status")))


def downloads_only(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("class") == schemas.DOWNLOAD)

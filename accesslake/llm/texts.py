"""What the text operators share: words, row keys, per-text Python and tables in the shared folder."""

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from accesslake.session import scratch_path

SPACED_WORD = r"[^\x20\x09-\x0D]+"
NOT_ALNUM = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Characters of text whose results are held at a time before they leave for the JVM.
SLICE_CHARS = 2_000_000
#: Rows of a table with about a megabyte each that go to Python at a time.
BATCH_ROWS, BATCH_CONF = 16, "spark.sql.execution.arrow.maxRecordsPerBatch"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """A-Z only, as the contracts ask: other letters stay."""
    return F.translate(text, UPPER, LOWER)


def alnum_words(text: Column) -> Column:
    """Lower-cased words of ASCII letters, digits and everything beyond ASCII; a null text has none."""
    return F.array_remove(F.split(lower_ascii(F.coalesce(text, F.lit(""))), NOT_ALNUM), "")


def row_key(doc_id: str, text: str) -> list[Column]:
    """Columns that tell documents apart even where ids repeat or are missing; equal rows are equal."""
    return [
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(F.lit(1), F.coalesce(F.col(text), F.lit(""))).alias("_k1"),
        F.xxhash64(F.lit(2), F.coalesce(F.col(text), F.lit(""))).alias("_k2"),
    ]


def same_key(left: str, right: str) -> Column:
    """Null-safe equality of ``row_key`` columns."""
    same = F.col(f"{left}.doc_id").eqNullSafe(F.col(f"{right}.doc_id"))
    return same & (F.col(f"{left}._k1") == F.col(f"{right}._k1")) & (F.col(f"{left}._k2") == F.col(f"{right}._k2"))


def slices(texts: pd.Series, most: int = SLICE_CHARS) -> Iterator[slice]:
    """Consecutive rows of a batch, in slices whose texts have at most so many characters together, or of one row."""
    start = held = 0
    for i, t in enumerate(texts):
        size = len(t) if t is not None else 0
        if held and held + size > most:
            yield slice(start, i)
            start, held = i, 0
        held += size
    if len(texts) > start:
        yield slice(start, len(texts))


def per_text(schema: str, make: Callable[[], Callable[[str], tuple]]) -> Callable[[Column], Column]:
    """A struct column computed from each text in Arrow batches; a null text counts as an empty one.

    ``make`` runs once for each task, so that models and caches are set up there.
    """
    names = [part.split()[0] for part in schema.split(",")]

    @pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        work = make()
        for texts in batches:
            for part in slices(texts):
                yield pd.DataFrame([work(t or "") for t in texts.iloc[part]], columns=names)

    return run


@contextmanager
def wide_rows(spark: SparkSession) -> Iterator[None]:
    """What runs inside the block sends BATCH_ROWS rows to Python at a time."""
    before = spark.conf.get(BATCH_CONF)
    spark.conf.set(BATCH_CONF, BATCH_ROWS)
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, before)


def with_result(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Rows with a column added under a name, to which underscores are appended while the rows have such a column."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return df.withColumn(name, value)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a table below the shared folder and read it again: executors may be lost from here on."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

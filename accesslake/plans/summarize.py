"""Roll up a store's raw facts, in place or from a landing zone."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from accesslake.operators.rollup import (
    daily_rollup,
    rollup_bounds,
    rollup_savings,
    summarize,
    year_range,
    year_rollover,
)
from accesslake.operators.star import fact_rows
from accesslake.plans.store import Store
from accesslake.session import sized_shuffles
from accesslake.sources import tables


def stage_summary(
    spark: SparkSession,
    store: Store,
    first: str | None = None,
    last: str | None = None,
    year: int | None = None,
    compact: bool = False,
) -> int:
    """Stage the summary rows of a range of days in the store's journal; returns rows saved."""
    if year is not None:
        if first or last:
            raise ValueError("give a year or a first and last day, not both")
        first, last = year_range(year)
    store.recover(spark)
    facts = store.facts(spark)
    bounds = rollup_bounds(facts).first()
    first, last = first or bounds.first_day, last or bounds.last_day
    if first is None or last is None:
        return 0
    within = facts.filter(F.col("dt").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    if not compact:
        raw_days = within.filter(~F.col("summary")).select("dt").distinct()
        within = within.join(F.broadcast(raw_days), "dt", "left_semi")  # at most one row per day of the range
    with sized_shuffles(facts):
        saved = rollup_savings(within).agg(F.sum("saved")).first()[0] or 0
        store.journal.stage(summarize(within, compact=compact), store.facts_table, "dt")
    return saved


def summarize_store(
    spark: SparkSession,
    store: Store,
    first: str | None = None,
    last: str | None = None,
    year: int | None = None,
    compact: bool = False,
) -> int:
    """Replace raw facts by summary rows for every day of the range at once; returns rows saved.

    Bounds not given are the first and last day with raw rows. Days without raw rows are left alone
    unless ``compact``. The rows are staged in the store's journal: if the job is lost while days are replaced, the next
    job on the store finishes it.
    """
    saved = stage_summary(spark, store, first, last, year, compact)
    store.recover(spark)
    return saved


def roll_over(spark: SparkSession, store: Store, target: Store) -> None:
    """Write all facts of a store, summarised, as another store's facts."""
    store.recover(spark)
    facts = store.facts(spark)
    with sized_shuffles(facts):
        tables.append_facts(year_rollover(facts), target.facts_path)


def reroll_days(landed: DataFrame, daily_path: str, days: DataFrame | None = None) -> None:
    """Recompute the summary rows of some days from landed downloads, late arrivals included.

    ``days.dt`` prunes the landing partitions read. Landed rows stay, so the result is the same
    however often a day is done.
    """
    if days is not None:
        landed = landed.join(F.broadcast(days.select("dt").distinct()), "dt", "left_semi")  # calendar days
    (
        daily_rollup(fact_rows(landed))
        .hint("rebalance", "dt")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("dt")
        .parquet(daily_path)
    )

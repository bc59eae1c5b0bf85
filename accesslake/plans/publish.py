"""Bring what streams and ``consume_logs`` have landed into a store."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from accesslake.operators.star import fact_rows
from accesslake.plans.store import Store
from accesslake.session import sized_shuffles
from accesslake.streaming.ingest import Landing

MARK = "landing"


def publishable(spark: SparkSession, landing: Landing, store: Store, mark: str = MARK) -> list[int]:
    """Landed batches that the store does not have, up to the first that is not whole."""
    last = store.journal.mark(spark, mark)
    number = 0 if last is None else last + 1
    found = []
    while landing.is_whole(spark, number):
        found.append(number)
        number += 1
    return found


def stage_publication(spark: SparkSession, landing: Landing, store: Store, mark: str = MARK) -> list[int]:
    """Add the batches' files and agents to the store and stage the days they touch; the facts follow when the
    store's journal is finished."""
    store.recover(spark)
    batches = publishable(spark, landing, store, mark)
    if not batches:
        return batches
    downloads = landing.downloads(spark, batches)
    with sized_shuffles(downloads):
        store.add_files(spark, downloads)
        store.add_agents(spark, downloads)
        fresh = fact_rows(downloads)
        facts = store.facts(spark)
        days = F.broadcast(downloads.select("dt").distinct())  # calendar days
        rows = facts.join(days, "dt", "left_semi").select(*fresh.columns).unionByName(fresh)
        store.journal.stage(rows, store.facts_table, "dt", mark=(mark, batches[-1]))
    return batches


def publish_landing(spark: SparkSession, landing: Landing, store: Store, mark: str = MARK) -> list[int]:
    """Bring the batches above the store's mark into it; returns their numbers.

    Only those batches' folders are read. A day they touch is rewritten with its facts and the new ones, whatever else has
    been written to it and whether it has been summarised or not; the mark is raised with the days. So a publication that
    is cut off anywhere, or done again, counts each download once. A store that takes in several landing zones keeps a mark for each. Raw lines and
    malformed ones stay in the landing zone.
    """
    batches = stage_publication(spark, landing, store, mark)
    store.recover(spark)
    return batches

"""Changes of stored tables that are written whole before they are put in place, and finished after a loss.

A change replaces some partitions of a table. Its rows are staged below the journal, and a small entry file, written
last, makes it count: a change without entry has not touched its table and is dropped, one with an entry is
put in place, which may be done any number of times. A store's jobs finish what is pending before they begin. One
job at a time may change a store.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from accesslake.sources import tables

ENTRY = "entry.json"


@dataclass(frozen=True)
class Journal:
    """Changes of tables below ``root``, numbered in their order."""

    root: str

    @property
    def path(self) -> str:
        return f"{self.root}/journal"

    def _changes(self, spark: SparkSession) -> list[int]:
        return sorted(int(n.removeprefix("change=")) for n in tables.child_names(spark, self.path) if n.startswith("change="))

    def _folder(self, number: int) -> str:
        return f"{self.path}/change={number}"

    def stage(
        self, rows: DataFrame, table: str, by: str, emptied: list[int] | None = None, mark: tuple[str, int] | None = None
    ) -> str:
        """Write the rows of a table's partitions ``by``; returns where they are. Nothing is changed yet.

        ``table`` is a path below the root. Partitions in ``emptied`` that get no row are removed. With
        ``mark`` a named number is raised together with the change.
        """
        spark = rows.sparkSession
        folder = self._folder(max(self._changes(spark), default=0) + 1)
        staged = f"{folder}/rows"
        rows.hint("rebalance", by).write.mode("overwrite").partitionBy(by).parquet(staged)
        entry = {"table": table, "by": by, "schema": rows.schema.jsonValue(), "emptied": emptied or [], "mark": mark}
        tables.write_text(spark, f"{folder}/{ENTRY}", json.dumps(entry))
        return staged

    def stage_folders(self, rows: DataFrame, table: str, by: str) -> str:
        """Stage partitions of text, a ``line`` each row, which are put in place as the folders they are, in the rows' order."""
        spark = rows.sparkSession
        folder = self._folder(max(self._changes(spark), default=0) + 1)
        staged = f"{folder}/rows"
        rows.select("line", by).write.mode("overwrite").partitionBy(by).text(staged)
        tables.write_text(spark, f"{folder}/{ENTRY}", json.dumps({"table": table, "by": by, "folders": True}))
        return staged

    def pending(self, spark: SparkSession) -> bool:
        return bool(self._changes(spark))

    def finish(self, spark: SparkSession) -> None:
        """Put all staged changes in place, in their order."""
        for number in self._changes(spark):
            folder = self._folder(number)
            if tables.path_exists(spark, f"{folder}/{ENTRY}"):
                self._apply(spark, folder, json.loads(tables.read_text(spark, f"{folder}/{ENTRY}")))
            tables.drop_path(spark, folder)

    def _apply(self, spark: SparkSession, folder: str, entry: dict) -> None:
        by, table = entry["by"], f"{self.root}/{entry['table']}"
        if entry.get("folders"):
            for name in tables.child_names(spark, f"{folder}/rows"):
                if name.startswith(f"{by}="):  # those that are in place already are no longer here
                    tables.replace_folder(spark, f"{folder}/rows/{name}", f"{table}/{name}")
            return
        filled = {n for n in tables.child_names(spark, f"{folder}/rows") if n.startswith(f"{by}=")}
        if filled:
            schema = T.StructType.fromJson(entry["schema"])
            tables.overwrite_partitions(spark.read.schema(schema).parquet(f"{folder}/rows"), table, by)
        for value in entry["emptied"]:
            if f"{by}={value}" not in filled:
                tables.drop_path(spark, f"{table}/{by}={value}")
        if entry["mark"]:
            name, number = entry["mark"]
            tables.write_text(spark, f"{self.root}/marks/{name}/{number}", "")

    def mark(self, spark: SparkSession, name: str) -> int | None:
        """The highest number a change has raised a mark to."""
        return max((int(n) for n in tables.child_names(spark, f"{self.root}/marks/{name}") if n.isdigit()), default=None)

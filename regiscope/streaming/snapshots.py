"""Incremental ingest of monthly snapshot folders with Structured Streaming."""

from __future__ import annotations

import fnmatch
import json
from collections.abc import Callable, Iterable

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.functions.clean import month_label
from regiscope.plans.load import load_registry
from regiscope.plans.publish import published_month
from regiscope.schemas import FEED_GLOBS
from regiscope.sources import months, zipcsv

def snapshot_files(spark: SparkSession, folder_glob: str) -> DataFrame:
    """``(path, month)`` of the files below the folders; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder_glob)
    return files.select("path", month_label(F.col("path")).alias("month"))


def latest_snapshot(df: DataFrame, month: str = "month") -> DataFrame:
    """Rows of the newest month only; the broadcast side is a single row."""
    newest = df.agg(F.max(month).alias(month))
    return df.join(F.broadcast(newest), month, "left_semi")


def missing_families(spark: SparkSession, folder: str, required: Iterable[str]) -> list[str]:
    """Required file name patterns (regular expressions) with no file in the folder."""
    patterns = list(required)
    if not patterns:
        return []
    files = snapshot_files(spark, folder)
    name = F.element_at(F.split("path", "/"), -1)
    counts = files.agg(*[F.count_if(name.rlike(p)).alias(str(i)) for i, p in enumerate(patterns)]).first()
    return [p for i, p in enumerate(patterns) if not counts[str(i)]]


def ingest_new_months(spark: SparkSession, root: str, target: str, checkpoint: str,
                      load: Callable[[SparkSession, str, str], None],
                      required: Iterable[str] = (), files: str = "*") -> None:
    """Load the newest complete month below ``root`` that is newer than the published one.

    One pass over the months that are complete since the last call (``availableNow``), by the streaming
    source ``snapshot_months``. The newest of them is loaded whole by ``load(spark, folder, month)``,
    which must publish to ``target`` with that month. An incomplete month waits for a later call, one that
    comes after a newer one is passed over. When ``load`` raises, the checkpoint stays where it was
    and the same months are offered again. The published month comes from the commit log, so a
    lost checkpoint does not load a month twice.
    """
    def on_batch(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        done = published_month(session, target)
        # One row per month folder.
        newest = max(((r.month, r.folder) for r in batch.collect()), default=None)
        if newest and (done is None or newest[0] > done):
            load(session, newest[1], newest[0])

    for module in (zipcsv, months):
        cloudpickle.register_pickle_by_value(module)
    spark.dataSource.register(months.MonthSource)
    arrivals = spark.readStream.format("snapshot_months").options(files=files, required=json.dumps(list(required))).load(root)
    query = arrivals.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(on_batch).start()
    query.awaitTermination()


def required_archives() -> list[str]:
    """File name patterns a month must have: every feed but the tax regimes, which come from
    another source and never hold up a load."""
    return ["^" + fnmatch.translate(g) for feed, g in FEED_GLOBS.items() if feed != "regime"]


def ingest_registry(spark: SparkSession, root: str, target: str, checkpoint: str, **options) -> None:
    """Load and publish the newest complete month of archives below ``root``, aggregates
    included, if it is newer than the published one. Tax regimes that are absent load as none; files of
    theirs that are broken leave the published ones and hold up nothing."""
    def load_month(session: SparkSession, folder: str, month: str) -> None:
        load_registry(session, folder, target, month=month, **{"optional": ("regime",)} | options)

    ingest_new_months(spark, root, target, checkpoint, load_month, required_archives(), "*.zip")

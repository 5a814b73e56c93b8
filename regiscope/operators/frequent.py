"""The most frequent pairs of two columns, by mergeable summaries and an exact second pass.

Each task keeps a Misra-Gries summary: at most ``counters`` pairs with counts that are too small by no
more than what was taken off all of them, which is at most rows / (counters + 1). Summaries of tasks add
up, and so do their errors. A pair that no summary holds occurs no more often than the errors' sum; one
whose count and that sum stay below the k-th count cannot be among the first k. What is left is counted
exactly. When the k-th is not above the errors, summaries are made larger, and in the end all pairs counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiscope.session import work_path

COUNTERS, MOST_COUNTERS = 4_096, 65_536
# Fixed value: what stands between two values of a pair; no code holds it.
_BETWEEN = "\x1f"


def _summed(held: pa.Table, most: int) -> tuple[pa.Table, int]:
    """Counts by pair, cut to the ``most`` largest by taking the next one's count off all, and that count."""
    sums = held.group_by("pair").aggregate([("n", "sum")]).rename_columns(["pair", "n"])
    if sums.num_rows <= most:
        return sums, 0
    counts = sums.column("n").to_numpy()
    cut = int(np.partition(counts, -most - 1)[-most - 1])
    left = sums.set_column(1, "n", pa.array(counts - cut))
    return left.filter(pc.greater(left.column("n"), 0)), cut


def summaries(pairs: DataFrame, counters: int) -> DataFrame:
    """``(pair, n)`` of every task's summary; a row with a NULL pair holds the error of its task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("pair", pa.string()), ("n", pa.int64())])
        held, error = schema.empty_table(), 0
        for batch in batches:
            counts = pa.Table.from_arrays(pc.value_counts(batch.column(0)).flatten(), schema=schema)
            held, cut = _summed(pa.concat_tables([held, counts]), counters)
            error += cut
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([error], pa.int64())], schema=schema)
        yield from held.select(schema.names).cast(schema).to_batches()

    return pairs.mapInArrow(run, "pair string, n long")


def frequent_pairs(df: DataFrame, first: str, second: str, k: int, counters: int = COUNTERS) -> DataFrame:
    """The ``k`` most frequent pairs ``(a, b, n, parte)``, exactly: by number, then by the values as text.

    Rows with a NULL in either column are left out; ``parte`` is the pair's share of the others. ``a`` and ``b``
    are texts.
    """
    spark = df.sparkSession
    a, b = F.col(first).cast("string"), F.col(second).cast("string")
    pairs = df.filter(a.isNotNull() & b.isNotNull()).select(F.concat_ws(_BETWEEN, a, b).alias("pair"))
    total = pairs.count()
    counted = None
    while counted is None and counters <= MOST_COUNTERS:
        path = work_path(spark, "summaries")
        summaries(pairs, counters).write.parquet(path)
        made = spark.read.parquet(path)
        error = made.filter("pair is null").agg(F.sum("n")).first()[0] or 0
        merged = made.filter("pair is not null").groupBy("pair").agg(F.sum("n").alias("n"))
        # At most k rows.
        top = [r.n for r in merged.orderBy(F.desc("n")).limit(k).collect()]
        if error == 0:
            counted = merged
        elif len(top) == k and top[-1] > error:
            # Those that can be among the first k: more than all counters of a task only if tasks differ.
            possible = merged.filter(F.col("n") + error >= top[-1]).select("pair")
            counted = pairs.join(possible, "pair", "left_semi").groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
        counters *= 4
    if counted is None:
        counted = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    values = F.split("pair", _BETWEEN, 2)
    rows = counted.select(values[0].alias("a"), values[1].alias("b"), "n", (F.col("n") / F.lit(max(total, 1))).alias("parte"))
    return rows.orderBy(F.desc("n"), "a", "b").limit(k)


def dependencies(df: DataFrame, first: str, second: str) -> DataFrame:
    """Per value ``a`` of the first column its rows ``n``, its most frequent partner ``b``, ties by text, and ``grau``, the share of
    rows with that partner: 1 where the value decides the other column.

    Pairs are counted first, so a value with most of the rows is as many rows as it has partners.
    """
    present = df.select(F.col(first).cast("string").alias("a"), F.col(second).cast("string").alias("b")).dropna()
    pairs = present.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("n"), "b"))
    tops = pairs.withColumn("_rank", best).filter("_rank = 1").select(F.col("a").alias("_a"), "b", F.col("n").alias("_n"))
    rows = pairs.groupBy("a").agg(F.sum("n").alias("n"))
    return rows.join(tops, F.col("a") == F.col("_a")).select("a", "n", "b", (F.col("_n") / F.col("n")).alias("grau"))

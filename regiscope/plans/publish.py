"""Published tables: written versions plus a commit log that says which one is current.

A table version is a folder of its own, never overwritten. A publication ends with one small
file appended to the log; until then readers keep the version they had. Tables committed
together become current together, so readers never mix two loads.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from regiscope.operators.dedup import with_surrogate_id
from regiscope.operators.documents import CHILD_TABLES, HOT_TABLE
from regiscope.session import remove

_LOG_SCHEMA = StructType([
    StructField("seq", LongType(), False),
    StructField("month", StringType()),
    StructField("table_name", StringType(), False),
    StructField("path", StringType(), False),
])
# In place of a path: the table is no longer published.
_RETIRED = ""
# Tables made from another begin with this and its name.
DERIVED = "indice_"
BITMAPS = f"{DERIVED}estabelecimento_bits"
SKETCHES = f"{DERIVED}regime_tributario_esbocos"
# Those made from further tables.
ALSO_FROM = {BITMAPS: "estabelecimento_cnae_secundario", SKETCHES: "estabelecimento"}
# Rows per file: keeps one task's output in several files that later scans can share out.
MAX_FILE_ROWS = 5_000_000


def _log_path(root: str) -> str:
    return f"{root.rstrip('/')}/commits"


def commit_log(spark: SparkSession, root: str) -> DataFrame:
    """All publications so far; empty before the first one."""
    try:
        return spark.read.schema(_LOG_SCHEMA).parquet(_log_path(root))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _LOG_SCHEMA)


def current_versions(spark: SparkSession, root: str) -> dict[str, str]:
    """Path of the current version of each table: one row per table, so it is collected."""
    newest = commit_log(spark, root).groupBy("table_name").agg(F.max_by("path", "seq").alias("path"))
    return {row.table_name: row.path for row in newest.collect() if row.path != _RETIRED}


def published_month(spark: SparkSession, root: str) -> str | None:
    """Newest month published so far."""
    return commit_log(spark, root).agg(F.max("month")).first()[0]


def new_version() -> str:
    """A folder name for a version; the tables of one load can share it."""
    return f"{time.time_ns()}-{uuid.uuid4().hex[:8]}"


def write_version(df: DataFrame, root: str, table: str, partition_by: str | None = None,
                  cluster_by: Sequence[str] = (), bloom: Sequence[str] = (),
                  version: str | None = None, surrogate_id: str | None = None) -> str:
    """Write a new version and return its path; readers do not see it before the commit.

    ``cluster_by`` range-partitions and sorts the rows, so that each file holds a narrow range
    of the keys and point lookups skip the others. With ``partition_by`` the range begins with
    that column: a state that holds a third of the rows is cut by the further keys into as many
    ranges as it needs, and no task writes it alone. ``bloom`` columns get Parquet bloom
    filters, for lookups by a column the rows are not ordered by. ``surrogate_id`` names an id column
    to add: it is numbered after the last shuffle, where a task run again replaces its own rows.
    """
    path = version_path(root, table, version or new_version())
    order = [*([partition_by] if partition_by else []), *cluster_by]
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    if surrogate_id:
        rows = with_surrogate_id(rows, surrogate_id)
    writer = rows.write.option("maxRecordsPerFile", MAX_FILE_ROWS)
    for column in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if bloom:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    if partition_by and _is_bare(df.sparkSession, path):
        # No rows, no folders: one empty file keeps the columns.
        df.limit(0).coalesce(1).write.mode("append").parquet(path)
    return path


def _is_bare(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return True
    return False


def version_path(root: str, table: str, version: str) -> str:
    return f"{root.rstrip('/')}/{table}/{version}"


def commit(spark: SparkSession, root: str, paths: dict[str, str], month: str | None = None,
           retired: Iterable[str] = ()) -> None:
    """Make written versions current and tables ``retired`` disappear, all at once."""
    seq = time.time_ns()
    paths = {table: _RETIRED for table in retired} | paths
    rows = [(seq, month, table, path) for table, path in sorted(paths.items())]
    spark.createDataFrame(rows, _LOG_SCHEMA).coalesce(1).write.mode("append").parquet(_log_path(root))


def publish(df: DataFrame, root: str, table: str, partition_by: str | None = None,
            cluster_by: Sequence[str] = (), bloom: Sequence[str] = (), month: str | None = None) -> str:
    """Replace one table by a full snapshot; running it again gives the same content.

    The list of hot companies was counted on the children published with it. When one of them is
    replaced the list goes, and documents count anew. What else was made from the table, such as the index
    of its names, goes as well.
    """
    spark = df.sparkSession
    path = write_version(df, root, table, partition_by, cluster_by, bloom)
    held = current_versions(spark, root)
    stale = [HOT_TABLE] if table in CHILD_TABLES.values() and HOT_TABLE in held else []
    stale += [t for t in held if t.startswith(f"{DERIVED}{table}_") or ALSO_FROM.get(t) == table]
    commit(spark, root, {table: path}, month, stale)
    return path


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Current version of one table."""
    return _read(spark, current_versions(spark, root)[table])


def _read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def tables(spark: SparkSession, root: str, views: bool = False) -> dict[str, DataFrame]:
    """Current version of every table, from one look at the log; optionally as temp views."""
    found = {name: _read(spark, path) for name, path in current_versions(spark, root).items()}
    if views:
        for name, df in found.items():
            df.createOrReplaceTempView(name)
    return found


def drop_old_versions(spark: SparkSession, root: str) -> int:
    """Delete the folders of superseded versions; returns how many were deleted."""
    keep = {_RETIRED, *current_versions(spark, root).values()}
    old = [r.path for r in commit_log(spark, root).select("path").distinct().collect()]
    return sum(remove(spark, path) for path in old if path not in keep)

"""Boilerplate lines: lines on more than a share of their site's pages.

Pages are grouped by host. For each line of a host, the pages that contain it are divided by the
host's pages; a line above ``ratio`` is dropped from all pages of the host. A line on one page only
is that page's own and no boilerplate, however small the host. Lines are compared by their text,
without the white space around them; blank lines are left alone.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiscope.llm.common import written

RATIO = 0.1
MIN_PAGES = 2
# Boilerplate lines, counted, that are sent to all executors, in all and of one host; beyond, they are
# joined to lines.
BROADCAST_LINES = 50_000
HOST_LINES = 300


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _lines(text: str | Column) -> Column:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                min_pages: int = MIN_PAGES) -> DataFrame:
    """``(host, line, pages, of)`` of the lines above the ratio.

    A page counts once for each of its lines. NULL hosts are a host of their own. Lines are counted by
    (host, hash) first, within tasks before the shuffle, so neither a large host nor a line on all
    its pages meets in one task; those above the ratio are then counted by their text.
    """
    pages = docs.groupBy(F.col(host).alias("_h")).agg(F.count(F.lit(1)).alias("of"))
    bare = F.filter(F.transform(_lines(F.col(text)), _bare), lambda x: x != "")
    hashes = F.array_distinct(F.transform(bare, lambda x: F.xxhash64(x)))
    seen = docs.select(F.col(host).alias("host"), F.explode(hashes).alias("code"))
    counted = seen.groupBy("host", "code").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
    often = written(counted.join(pages, F.col("host").eqNullSafe(F.col("_h"))).filter(
        F.col("pages") > ratio * F.col("of")).select(F.col("host").alias("_h"), "code", "of"), "often")
    lines = docs.select(F.col(host).alias("host"), F.explode(F.array_distinct(bare)).alias("line"))
    same = F.col("host").eqNullSafe(F.col("_h")) & (F.xxhash64("line") == F.col("code"))
    found = lines.join(often, same).groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages"), F.first("of").alias("of"))
    return found.filter((F.col("pages") >= min_pages) & (F.col("pages") > ratio * F.col("of")))


def drop_boilerplate(docs: DataFrame, host: str = "source", text: str = "text", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, limit: int = BROADCAST_LINES) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text`` and their number as ``_dropped``.

    NULL texts stay NULL with 0 dropped; a page may become empty. Repeated rows are pages each.
    Further columns stay, whatever their names; one named ``_dropped`` gives way to the result.
    """
    tag = uuid.uuid4().hex[:8]
    row, of, drop, kept = (f"_{name}_{tag}" for name in ("row", "of", "drop", "kept"))
    found = written(boilerplate(docs, host, text, ratio, min_pages), "boilerplate")
    lists = found.groupBy(F.col("host").alias(of)).agg(F.collect_set("line").alias(drop))
    sizes = found.groupBy("host").agg(F.count(F.lit(1)).alias("n")).agg(F.sum("n").alias("n"), F.max("n").alias("top")).first()
    if (sizes.n or 0) <= limit and (sizes.top or 0) <= HOST_LINES:
        # No blank line is among them.
        joined = docs.join(F.broadcast(lists), F.col(host).eqNullSafe(F.col(of)), "left")
        left = F.filter(_lines(F.col(text)), lambda x: ~F.array_contains(drop, _bare(x)))
    else:
        # Too many to send: find the places of the lines by a join on (host, line), then cut them out.
        rows = written(docs.withColumn(row, F.monotonically_increasing_id()), "pages")
        places = rows.select(F.col(row).alias("_r"), F.col(host).alias("_h"), F.posexplode(_lines(F.col(text))).alias("_at", "_line"))
        hits = places.join(found, (_bare(F.col("_line")) == F.col("line")) & F.col("_h").eqNullSafe(F.col("host")))
        hits = hits.groupBy(F.col("_r").alias(of)).agg(F.collect_list("_at").alias(drop))
        joined = rows.join(hits, F.col(row) == F.col(of), "left")
        left = F.filter(_lines(F.col(text)), lambda x, i: ~F.array_contains(drop, i))
    changed = F.col(drop).isNotNull() & F.col(text).isNotNull()
    joined = joined.withColumn(kept, F.when(changed, left))
    dropped = F.coalesce(F.size(_lines(F.col(text))) - F.when(changed, F.size(kept)), F.lit(0)).cast("long")
    new = F.coalesce(F.array_join(kept, "\n"), F.col(text))
    return joined.select(*(new.alias(c) if c == text else F.col(c) for c in docs.columns if c != "_dropped"), dropped.alias("_dropped"))

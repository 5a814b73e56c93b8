"""Loads: raw archives to published tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from typing import TypeVar

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.operators import aggregates
from regiscope.operators.documents import HOT_TABLE, hot_companies
from regiscope.operators.sample import coherent_sample, first_archive_anchor
from regiscope.operators.transform import (
    REJECTS, reject_all, rejects, transform_all, transform_regime,
)
from regiscope.plans.bitmaps import write_bitmaps
from regiscope.plans.cube import CUBE, SIZES, write_cube
from regiscope.plans.marts import MART_KEYS, write_marts
from regiscope.plans.name_index import INDEXED, index_tables, write_index
from regiscope.plans.publish import (
    BITMAPS, MAX_FILE_ROWS, SKETCHES, commit, current_versions, new_version, read_table, tables, version_path,
    write_version,
)
from regiscope.plans.sketches import write_sketches
from regiscope.schemas import ARRIVAL, CORRUPT, DOMAINS, STAGING_COLUMNS, STAGING_SCHEMAS
from regiscope.session import remove, work_path
from regiscope.sources.domains import domain_dim
from regiscope.sources.feeds import missing_feeds, read_feed, read_optional

T = TypeVar("T")
_LOG = logging.getLogger(__name__)
# What an unreadable file or value raises, by way of Spark.
FAILURES = (PySparkException, Py4JJavaError, OSError)
REGIME = "regime_tributario"
JOBS_AT_ONCE = 4
# Tables with a surrogate id, renewed at each load.
WITH_ID = ("socio", "regime_tributario")
# Tables of records of the wrong width: of all feeds but the regimes, and of the regimes.
BROKEN, BROKEN_REGIME = f"{REJECTS}records", f"{REJECTS}records_regime"
PARTITIONED = {"estabelecimento": "uf"}
# Columns by which rows are ranged over files; lookups by the first ones read few files. The
# further ones cut a hot value into as many ranges as it needs.
CLUSTERED = {
    "empresa": ("cnpj_basico",),
    "estabelecimento": ("cnpj_basico", "cnpj"),
    "simples": ("cnpj_basico",),
    "socio": ("cnpj_cpf_socio", "cnpj_basico", "nome_socio"),
    "regime_tributario": ("cnpj_basico", "cnpj", "ano"),
    "estabelecimento_cnae_secundario": ("cnae_cod", "cnpj"),
}
# Further lookup columns.
BLOOM = {
    "socio": ("cnpj_basico",),
    "estabelecimento_cnae_secundario": ("cnpj",),
}


def land(staging: DataFrame, feed: str, folder: str) -> DataFrame:
    """Write a feed as it came to Parquet in the shared folder and read it back.

    An archive is parsed once, by one task per member, whatever uses the feed later; the row
    bound per file makes the copy splittable.
    """
    path = f"{folder}/{feed}"
    staging.write.option("maxRecordsPerFile", MAX_FILE_ROWS).parquet(path)
    return staging.sparkSession.read.parquet(path)


def land_all(spark: SparkSession, folder: str, landing: str, mode: str = "failfast",
             optional: Sequence[str] = ()) -> dict[str, DataFrame]:
    """All feeds of a snapshot folder, landed; missing ones are empty, ``optional`` ones that cannot be read left out."""
    feeds = {feed: read_feed(spark, folder, feed, mode=mode) for feed in STAGING_COLUMNS}

    def job(feed: str, df: DataFrame) -> DataFrame | None:
        try:
            return land(df, feed, landing)
        except FAILURES as error:
            if feed not in optional:
                raise
            _unread(feed, folder, error)
            return None

    return {feed: df for feed, df in _side_by_side(job, feeds).items() if df is not None}


def _unread(feed: str, folder: str, error: Exception) -> None:
    _LOG.warning("feed %s of %s is left as it was: %s", feed, folder, str(error).split("\n")[0])


def land_sample(spark: SparkSession, folder: str, landing: str, n: int, mode: str = "failfast") -> dict[str, DataFrame]:
    """The feeds cut to a coherent sample on the way to their landing copies.

    The first establishment file alone gives the anchor; the others and the regimes are not read.
    """
    first = read_feed(spark, folder, "estabelecimentos", first_only=True, mode=mode)
    if mode == "quarantine":
        first = first.filter(F.col(CORRUPT).isNull())
    anchor = land(first_archive_anchor(first, n), "estabelecimentos", landing)
    others = {feed: read_feed(spark, folder, feed, mode=mode)
              for feed in STAGING_COLUMNS if feed not in ("estabelecimentos", "regime")}
    cut = coherent_sample(others | {"estabelecimentos": anchor}, n, anchor)
    staging = _side_by_side(lambda feed, df: land(df, feed, landing), {feed: cut[feed] for feed in others})
    empty = spark.createDataFrame([], anchor.select(*ARRIVAL).schema)
    regime = empty.select(*(F.lit(None).cast("string").alias(c) for c in STAGING_COLUMNS["regime"]), *ARRIVAL)
    return staging | {"estabelecimentos": anchor, "regime": regime}


def _broken_records(staging: dict[str, DataFrame]) -> DataFrame:
    """``(feed, _file, _line, _corrupt_record)`` of the records of the wrong width."""
    found = [
        df.filter(F.col(CORRUPT).isNotNull()).select(F.lit(feed).alias("feed"), *ARRIVAL, CORRUPT)
        for feed, df in staging.items() if CORRUPT in df.columns
    ]
    return reduce(DataFrame.unionByName, found)


def _whole_records(staging: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        feed: df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in df.columns else df
        for feed, df in staging.items()
    }


def write_tables(root: str, typed: dict[str, DataFrame], version: str | None = None) -> dict[str, str]:
    """Write new versions of typed tables, a few at a time, and return their paths."""
    def write(name: str, df: DataFrame) -> str:
        return write_version(df, root, name, PARTITIONED.get(name), CLUSTERED.get(name, ()),
                             BLOOM.get(name, ()), version, "id" if name in WITH_ID else None)

    return _side_by_side(write, typed)


def _side_by_side(job: Callable[[str, DataFrame], T], frames: dict[str, DataFrame]) -> dict[str, T]:
    """Run a job per table; small tables fill the gaps that a large one leaves."""
    with ThreadPoolExecutor(JOBS_AT_ONCE) as pool:
        return dict(zip(frames, pool.map(job, frames.keys(), frames.values())))


def load_registry(spark: SparkSession, folder: str, root: str, month: str | None = None,
                  sample: int = 0, keep_staging: str | None = None, required: Sequence[str] = (),
                  name_index: Sequence[str] = (), bitmaps: bool = False, sketches: bool = False,
                  cube: bool = False, optional: Sequence[str] = (), **options) -> DataFrame:
    """A full load, or a coherent sample of ``sample`` branches, ending with the row counts.

    Feeds that the folder lacks (``missing_feeds`` names them) load as empty tables, unless they are
    ``required``; a sample requires the establishments. Everything is written first and
    committed together; what a failed load wrote is removed. ``keep_staging`` is a path to land
    the feeds at and leave them. ``name_index`` names tables whose names are to be indexed, ``bitmaps``,
    ``cube`` and ``sketches`` ask for those of the branches and regimes; what is published already is made anew.
    With ``optional=["regime"]`` regimes that cannot be read or loaded never hold up the rest: those that are
    published stay as they are.

    With ``strict=False`` values that do not parse become NULL, rows without a required value and
    records of the wrong width stay out, and all of them are published: ``rejects_<table>`` by
    table, ``rejects_records`` (and ``rejects_records_regime``) by feed. A strict load ends with no
    such tables.
    """
    wanted = {*required, *(["estabelecimentos"] if sample > 0 else [])}
    if lacking := sorted(wanted.intersection(missing_feeds(folder))):
        raise FileNotFoundError(f"{folder} has no files of {', '.join(lacking)}")
    strict = options.get("strict", True)
    mode = "failfast" if strict else "quarantine"
    landing, version = keep_staging or work_path(spark, "staging"), new_version()
    names = [*MART_KEYS, HOT_TABLE]
    try:
        landed = land_sample(spark, folder, landing, sample, mode) if sample > 0 else land_all(
            spark, folder, landing, mode, optional)
        lost = "regime" not in landed
        if lost:
            landed["regime"] = read_optional(spark, f"{folder}/-", STAGING_SCHEMAS["regime"], mode=mode)
        staging = _whole_records(landed)
        typed = transform_all(staging, **options)
        typed |= {name: domain_dim(spark, name) for name in DOMAINS}
        if not strict:
            typed |= reject_all(staging, **options)
            typed[BROKEN] = _broken_records({f: df for f, df in landed.items() if f != "regime"})
            if CORRUPT in landed["regime"].columns:
                typed[BROKEN_REGIME] = _broken_records({"regime": landed["regime"]})
        names += typed
        regimes = {n: typed.pop(n) for n in (REGIME, f"{REJECTS}{REGIME}", BROKEN_REGIME) if n in typed} if "regime" in optional else {}
        paths = write_tables(root, typed, version)
        if regimes:
            paths |= _regimes(spark, root, folder, regimes, version, lost)
        written = {name: spark.read.parquet(path) for name, path in paths.items()}
        if REGIME not in written:
            written[REGIME] = read_table(spark, root, REGIME)
        paths |= write_marts(spark, root, written["empresa"], written["estabelecimento"], version)
        paths[HOT_TABLE] = write_version(hot_companies(written), root, HOT_TABLE, version=version)
        for table in _indexed(spark, root, name_index):
            names += index_tables(table).values()
            paths |= write_index(root, table, written[table], *INDEXED[table], version)
        held = current_versions(spark, root)
        if bitmaps or BITMAPS in held:
            names.append(BITMAPS)
            paths |= write_bitmaps(root, written["estabelecimento"], written["estabelecimento_cnae_secundario"], version)
        if cube or CUBE in held:
            names += [CUBE, SIZES]
            paths |= write_cube(root, written["estabelecimento"], version=version)
        if sketches or SKETCHES in held:
            names.append(SKETCHES)
            paths |= write_sketches(root, written["regime_tributario"], written["estabelecimento"], version)
    except Exception:
        for name in names:
            remove(spark, version_path(root, name, version))
        raise
    finally:
        if not keep_staging:
            remove(spark, landing)
    retired = _outdated(spark, root, paths)
    if REGIME not in paths:
        retired = [t for t in retired if t not in (f"{REJECTS}{REGIME}", BROKEN_REGIME)]
    commit(spark, root, paths, month, retired)
    return aggregates.load_audit(written)


def _regimes(spark: SparkSession, root: str, folder: str, tables: dict[str, DataFrame], version: str, lost: bool) -> dict[str, str]:
    """Paths of the written regimes and their rejects; none when they cannot be loaded and there are some published."""
    if not lost:
        try:
            return write_tables(root, tables, version)
        except FAILURES as error:
            for name in tables:
                remove(spark, version_path(root, name, version))
            _unread("regime", folder, error)
    if REGIME in current_versions(spark, root):
        return {}
    return write_tables(root, {REGIME: tables[REGIME].limit(0)}, version)


def _indexed(spark: SparkSession, root: str, wanted: Sequence[str]) -> list[str]:
    """Tables whose names a load has to index."""
    held = current_versions(spark, root)
    return [t for t in INDEXED if t in wanted or index_tables(t)["nomes"] in held]


def _outdated(spark: SparkSession, root: str, paths: dict[str, str], only: Sequence[str] = ()) -> list[str]:
    """Published tables of rejects, all or some, that a load does not renew."""
    held = [t for t in current_versions(spark, root) if t.startswith(REJECTS) and t not in paths]
    return [t for t in held if not only or t in only]


def load_regime(spark: SparkSession, folder: str, root: str, **options) -> DataFrame:
    """Replace the tax-regime table alone, with its tables of rejects, and report its summary."""
    strict = options.get("strict", True)
    landing, table = work_path(spark, "staging"), "regime_tributario"
    try:
        feed = read_feed(spark, folder, "regime", mode="failfast" if strict else "quarantine")
        landed = {"regime": land(feed, "regime", landing)}
        staging = _whole_records(landed)["regime"]
        typed = {table: transform_regime(staging, **options)}
        if not strict:
            ids = {k: v for k, v in options.items() if k == "id_pattern"}
            typed |= {f"{REJECTS}{table}": rejects(staging, table, **ids), BROKEN_REGIME: _broken_records(landed)}
        paths = write_tables(root, typed)
    finally:
        remove(spark, landing)
    regime = spark.read.parquet(paths[table])
    now = tables(spark, root) | {table: regime}
    if HOT_TABLE in now:
        paths[HOT_TABLE] = write_version(hot_companies(now), root, HOT_TABLE)
    if SKETCHES in now:
        paths |= write_sketches(root, regime, now["estabelecimento"])
    commit(spark, root, paths, retired=_outdated(spark, root, paths, (f"{REJECTS}{table}", BROKEN_REGIME)))
    return aggregates.regime_summary(regime)

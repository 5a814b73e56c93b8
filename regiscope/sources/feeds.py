"""Readers of the raw feeds: zip archives, plain files, lookups, optional sources."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from regiscope.functions import clean
from regiscope.schemas import CORRUPT, FEED_GLOBS, FILE, LINE, STAGING_SCHEMAS
from regiscope.sources import zipcsv

# No real field holds this text, so unquoted blanks (NULL) and quoted blanks stay apart.
_NO_VALUE = "\u0001"
_CORRUPT = StructField(CORRUPT, StringType())


def _with_arrival(schema: StructType) -> StructType:
    return StructType(schema.fields + [StructField(FILE, StringType()), StructField(LINE, LongType())])


def register_source(spark: SparkSession) -> None:
    """Make ``zip_csv`` known, with filters going down to it."""
    cloudpickle.register_pickle_by_value(zipcsv)
    spark.dataSource.register(zipcsv.ZipCsvSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def write_zip_csv(df: DataFrame, folder: str, prefix: str, mode: str = "append", **options) -> str:
    """An archive (or, with ``zipped=False``, a plain file) per partition that has rows; returns the folder.

    Rows in a single partition may go without the number in the name (``numbered=False``). A job that
    fails leaves no file, a task run again one. ``mode="overwrite"`` replaces the files of the prefix.
    """
    register_source(df.sparkSession)
    text = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
    df.write.format("zip_csv").mode(mode).options(prefix=prefix, **text).save(folder)
    return folder


def read_zip_csv(spark: SparkSession, path_glob: str, schema: StructType, sep: str = ";",
                 charset: str = "iso8859-15", header: bool = False, strip_cr: bool = False,
                 mode: str = "failfast") -> DataFrame:
    """Every member of every archive that matches, with ``_file`` and ``_line`` of each record.

    Filters on ``_file`` reach the source, so that other archives are not opened.
    """
    register_source(spark)
    wanted = _with_arrival(schema)
    if mode == "quarantine":
        wanted = StructType(wanted.fields + [_CORRUPT])
    return (
        spark.read.format("zip_csv").schema(wanted)
        .options(sep=sep, charset=charset, header=str(header), stripcr=str(strip_cr), mode=mode)
        .load(path_glob)
    )


def read_registry_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ";",
                      charset: str = "iso8859-15", header: bool = False, strip_cr: bool = False,
                      multiline: bool = True, mode: str = "failfast") -> DataFrame:
    """Plain files of the same dialect, and the same ``mode`` for records of the wrong width.

    ``_line`` orders the records of a file; it is no record number. ``multiline=False`` lets Spark
    split large files; use it for feeds known to hold no line break inside quotes. ISO-8859-15 is read as ISO-8859-1, which maps every byte to one
    character, and the eight differing characters are put right by an expression.
    """
    latin9 = charset.lower().replace("_", "-") in ("iso8859-15", "iso-8859-15", "latin9")
    lenient = mode == "quarantine"
    wanted = StructType(schema.fields + [_CORRUPT]) if lenient else schema
    raw = (
        spark.read.schema(wanted)
        .option("sep", sep).option("quote", '"').option("escape", '"')
        .option("nullValue", _NO_VALUE).option("emptyValue", "")
        .option("encoding", "ISO-8859-1" if latin9 else charset)
        .option("header", header).option("multiLine", multiline)
        .option("mode", "PERMISSIVE" if lenient else "FAILFAST")
        .option("columnNameOfCorruptRecord", _CORRUPT.name)
        .csv(path)
    )
    repair = clean.latin1_to_latin9 if latin9 else (lambda c: c)
    unwanted = "\u0000\r" if strip_cr else "\u0000"
    text = [repair(clean.without(F.col(f.name), unwanted)).alias(f.name) for f in schema]
    # The split's offset orders the splits of a file, the running id the rows of a split.
    split = F.shiftright("_metadata.file_block_start", 20)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    position = F.shiftleft(split, 33) + row
    broken = [F.col(_CORRUPT.name)] if lenient else []
    if lenient:
        text = [F.when(F.col(_CORRUPT.name).isNull(), t).alias(f.name) for t, f in zip(text, schema)]
    return raw.select(*text, F.col("_metadata.file_path").alias(FILE), position.alias(LINE), *broken)


def read_regime_csv(spark: SparkSession, path_glob: str, mode: str = "failfast") -> DataFrame:
    """Regime archives: comma, UTF-8, many files per archive, a header line in each."""
    rows = read_zip_csv(spark, path_glob, STAGING_SCHEMAS["regime"], sep=",", charset="utf8",
                        strip_cr=True, mode=mode)
    return drop_repeated_headers(rows)


def drop_repeated_headers(rows: DataFrame) -> DataFrame:
    """Header lines in any case, wherever they stand."""
    is_header = (
        F.lower("ano").eqNullSafe("ano")
        & F.lower("cnpj").eqNullSafe("cnpj")
        & F.coalesce(F.lower("cnpj_da_scp").startswith("cnpj_da_scp"), F.lit(False))
    )
    return rows.filter(~is_header)


def read_lookup(spark: SparkSession, path_glob: str) -> DataFrame:
    """A two-column code/text feed."""
    return read_zip_csv(spark, path_glob, STAGING_SCHEMAS["cnaes"])


def _patterns(folder: str, feed: str) -> tuple[str, str]:
    """Name patterns of a feed's archives and of its plain files."""
    archives = f"{folder.rstrip('/')}/{FEED_GLOBS[feed]}"
    return archives, archives.removesuffix(".zip") + ".csv"


def missing_feeds(folder: str) -> list[str]:
    """Feeds of which a snapshot folder holds neither archives nor plain files."""
    return [feed for feed in FEED_GLOBS if not any(map(zipcsv.list_archives, _patterns(folder, feed)))]


def read_feed(spark: SparkSession, folder: str, feed: str, first_only: bool = False, **options) -> DataFrame:
    """A feed of a snapshot folder: its archives, else its plain files, else an empty table.
    ``first_only`` reads the first of these files and opens no other.

    ``mode="quarantine"`` adds ``_corrupt_record``, the text of a record of the wrong width, whose
    other columns are NULL then; without it such a record fails the job.
    """
    schema = STAGING_SCHEMAS[feed]
    archives, plain = _patterns(folder, feed)
    if first_only:
        plain = next(iter(zipcsv.list_archives(plain)), plain)
        if first := next(iter(zipcsv.list_archives(archives)), None):
            return read_feed(spark, folder, feed, **options).filter(F.col(FILE).startswith(f"{first}!"))
    if zipcsv.list_archives(plain) and not zipcsv.list_archives(archives):
        if feed == "regime":
            rows = read_registry_csv(spark, plain, schema, sep=",", charset="UTF-8", strip_cr=True, **options)
            return drop_repeated_headers(rows)
        return read_registry_csv(spark, plain, schema, **options)
    if feed == "regime":
        return read_optional(spark, archives, schema, read_regime_csv, **options)
    return read_optional(spark, archives, schema, **options)


def read_optional(spark: SparkSession, path_glob: str, schema: StructType, reader=None,
                  **options) -> DataFrame:
    """The files that match, or an empty table of the same columns when none does."""
    if not zipcsv.list_archives(path_glob):
        wanted = _with_arrival(schema)
        lenient = options.get("mode") == "quarantine"
        return spark.createDataFrame([], StructType(wanted.fields + [_CORRUPT]) if lenient else wanted)
    if reader is None:
        return read_zip_csv(spark, path_glob, schema, **options)
    return reader(spark, path_glob, **options)

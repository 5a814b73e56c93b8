"""The corpus pipeline: five stages over ``documents``, each written and reread as the next one's input.

Every stage works on all that its predecessor kept, and all but the last return the columns of
documents. Rows are told apart by their whole content where ids repeat: of a group of near
duplicates one row stays, the one with the smallest ``doc_id`` (a row with a NULL id only where it
is alone; of rows with that id again, the smallest text).

Rows are whole texts, of which Spark's usual batches hold tens of MB at a time and in several copies,
so the stages lower the session's batches, unless the application has set them, and leave them so for
the rows they return. Results do not depend on them.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.llm import decontaminate, language_id, line_dedup, packing, simhash
from regiscope.llm.common import remainder, table, written

# A document whose most likely language is less likely than this is rejected.
LEAST_LANGUAGE_SCORE = 0.5
# Bytes of rows that go to a Python worker at a time, and rows that a scan decodes at a time.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": 2 << 20, "spark.sql.parquet.columnarReaderBatchSize": 512}


def small_batches(spark: SparkSession) -> None:
    """Batches for rows that are texts, where the session has no setting of its own."""
    own = spark.conf.getAll
    for name, most in BATCHES.items():
        if name not in own:
            spark.conf.set(name, str(most))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter and those of no language that the model is sure of.

    The model learns from the labelled rows as the registered query's does. When there are none,
    it knows no language and only texts without letters go.
    """
    small_batches(spark)
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = language_id.fit(docs.filter(~held).select("text", "lang"))
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    found = language_id.identify(docs, model, docs.columns)
    sure = (F.col("lang_pred") != language_id.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return found.filter(sure).select(*docs.columns)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take each site's boilerplate lines out of its documents; ``n_chars`` follows the text."""
    small_batches(spark)
    found = line_dedup.drop_boilerplate(docs)
    changed = F.when(F.col("_dropped") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.select(*(changed.alias(c) if c == "n_chars" else c for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (five words, similarity 0.8)."""
    small_batches(spark)
    rows = written(docs.withColumn("_row", F.monotonically_increasing_id()), "near-copies")
    groups = simhash.near_copies(rows.withColumn("_key", F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "_row")), key="_key")
    kept = groups.filter(F.col("_key") == F.col("component_id")).select(F.col("_key._row").alias("_kept"))
    return rows.join(kept, F.col("_row") == F.col("_kept"), "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of ten words of a benchmark item, or a shorter item whole."""
    small_batches(spark)
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document in a sequence of at most 2048 tokens."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=1)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# The first, third and last stage have no equivalent in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

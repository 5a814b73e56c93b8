"""Published aggregates kept up to date by what has changed between two versions of their table.

With an aggregate goes its state: per group the counts that deltas need, and per range of company ids
a digest of the rows counted. A refresh digests the current version, takes the ranges whose
digests differ, and reads the old and the new rows of those alone: the tables are ordered by the same
ids, so the ranges are few files. Their multiset difference, old rows counted down and new ones up, is
added to the groups. A group whose rows are all gone vanishes; a total whose values are all gone is NULL.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiscope.operators.aggregates import active
from regiscope.plans.marts import ACTIVE, CAPITAL
from regiscope.plans.publish import commit, current_versions, new_version, write_version

# Digits of a company id that make a range, and ranges beyond which all is recounted.
DIGITS = 4
MOST_RANGES = 2_000


@dataclass(frozen=True)
class Aggregate:
    """A count, and a total if ``amount`` is set, per ``keys`` of a table's rows."""

    mart: str
    table: str
    keys: tuple[str, ...]
    count: str
    amount: str | None = None
    total: str | None = None
    only_active: bool = False
    digits: int = DIGITS

    @property
    def state(self) -> str:
        return f"estado_{self.mart}"

    @property
    def digests(self) -> str:
        return f"resumo_{self.mart}"

    def rows(self, df: DataFrame) -> DataFrame:
        """What the aggregate counts: range, keys and amount."""
        rows = active(df) if self.only_active else df
        return rows.select(F.substring("cnpj_basico", 1, self.digits).alias("faixa"), "cnpj_basico", *self.keys,
                           *([F.col(self.amount).alias("_valor")] if self.amount else []))


MARTS = (
    Aggregate(CAPITAL, "empresa", ("natureza_juridica_cod",), "empresas", "capital_social", "capital_total"),
    Aggregate(ACTIVE, "estabelecimento", ("uf", "municipio_cod", "cnae_fiscal_principal"), "qtd", only_active=True),
)


def digests(of: Aggregate, df: DataFrame, path: str) -> DataFrame:
    """Per range the number of rows and the sum of their hashes; ``origem`` is the version that was counted."""
    rows = of.rows(df)
    hashed = F.xxhash64(*(c for c in rows.columns if c != "faixa")).cast("decimal(20,0)")
    return rows.groupBy("faixa").agg(F.count(F.lit(1)).alias("linhas"), F.sum(hashed).alias("soma")).withColumn("origem", F.lit(path))


def _signed(of: Aggregate, changes: DataFrame) -> DataFrame:
    """Groups of rows that each stand for ``_vezes`` rows, which may be below zero."""
    sums = [F.sum("_vezes").alias("n")]
    if of.amount:
        sums += [F.sum(F.col("_valor") * F.col("_vezes")).alias("soma"),
                 F.sum(F.when(F.col("_valor").isNotNull(), F.col("_vezes")).otherwise(0)).alias("com_valor")]
    return changes.groupBy(*of.keys).agg(*sums)


def changes(of: Aggregate, old: DataFrame, new: DataFrame, ranges: list[str | None] | None = None) -> DataFrame:
    """The multiset difference of two versions: rows with ``_vezes``, how many more of them the new one has.

    With ``ranges``, of those alone, which filters on the id bring to the files.
    """
    def part(df: DataFrame, sign: int) -> DataFrame:
        return of.rows(df if ranges is None else df.filter(_within(of, ranges))).withColumn("_vezes", F.lit(sign))

    rows = part(new, 1).unionByName(part(old, -1))
    columns = [c for c in rows.columns if c != "_vezes"]
    return rows.groupBy(*columns).agg(F.sum("_vezes").alias("_vezes")).filter("_vezes <> 0")


def _within(of: Aggregate, ranges: list[str | None]) -> Column:
    """Ids of the ranges: neighbours as one interval, so that few conditions reach the scan."""
    known, id_ = sorted(r for r in ranges if r is not None), F.col("cnpj_basico")
    runs: list[list[str]] = []
    for r in known:
        if runs and r.isdigit() and runs[-1][-1].isdigit() and int(r) == int(runs[-1][-1]) + 1 and len(r) == len(runs[-1][-1]):
            runs[-1].append(r)
        else:
            runs.append([r])
    conditions = [(id_ >= run[0]) & (id_ <= run[-1] + "\U0010FFFF") for run in runs]
    conditions += [id_.isNull()] * (None in ranges)
    exact = F.substring(id_, 1, of.digits)
    return reduce(Column.__or__, conditions, F.lit(False)) & (exact.isin(known) | exact.isNull())


def _mart(of: Aggregate, state: DataFrame) -> DataFrame:
    total = [F.when(F.col("com_valor") > 0, F.col("soma")).alias(of.total)] if of.amount else []
    return state.select(*of.keys, F.col("n").alias(of.count), *total)


def refresh_incremental(spark: SparkSession, root: str, month: str | None = None,
                        marts: tuple[Aggregate, ...] = MARTS) -> dict[str, int | None]:
    """Bring the aggregates up to the current tables; returns the ranges that were read again, None for a recount.

    All is counted the first time, when the version counted last is no longer there, and when most ranges changed.
    """
    paths, read, version = {}, {}, new_version()
    held = current_versions(spark, root)
    for of in marts:
        now = spark.read.parquet(held[of.table])
        fresh = write_version(digests(of, now, held[of.table]), root, of.digests, version=version)
        ranges = None
        if of.digests in held and of.state in held and of.mart in held:
            before, after = spark.read.parquet(held[of.digests]), spark.read.parquet(fresh)
            ranges = _changed(before, after)
            origin = before.select("origem").first()
            old = spark.read.parquet(origin.origem) if origin and _exists(spark, origin.origem) else now.limit(0)
            if ranges is not None and (origin is None or _exists(spark, origin.origem)):
                delta = _signed(of, changes(of, old, now, ranges))
                state = spark.read.parquet(held[of.state])
                state = _added(of, state, delta)
            else:
                ranges = None
        if ranges is None:
            state = _signed(of, of.rows(now).withColumn("_vezes", F.lit(1)))
        read[of.mart] = None if ranges is None else len(ranges)
        paths[of.digests] = fresh
        paths[of.state] = write_version(state, root, of.state, version=version)
        paths[of.mart] = write_version(_mart(of, spark.read.parquet(paths[of.state])), root, of.mart, version=version)
    commit(spark, root, paths, month)
    return read


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target))


def _changed(before: DataFrame, after: DataFrame) -> list[str | None] | None:
    """Ranges whose digests differ, or None for more than ``MOST_RANGES``."""
    old = before.select(F.col("faixa").alias("f"), F.col("linhas").alias("l"), F.col("soma").alias("s"), F.lit(True).alias("_old"))
    new = after.select("faixa", "linhas", "soma", F.lit(True).alias("_new"))
    both = new.join(old, F.col("faixa").eqNullSafe(F.col("f")), "full")
    differ = both.filter(F.col("_old").isNull() | F.col("_new").isNull() | (F.col("linhas") != F.col("l")) | (F.col("soma") != F.col("s")))
    found = differ.select(F.coalesce("faixa", "f").alias("faixa")).limit(MOST_RANGES + 1).collect()
    return None if len(found) > MOST_RANGES else [r.faixa for r in found]


def _added(of: Aggregate, state: DataFrame, delta: DataFrame) -> DataFrame:
    """State and deltas as one; what no row is left of goes."""
    sums = [F.sum(c).alias(c) for c in state.columns if c not in of.keys]
    kinds = {f.name: f.dataType for f in state.schema}
    out = state.unionByName(delta).groupBy(*of.keys).agg(*sums).filter("n <> 0")
    return out.select(*(F.col(c).cast(kinds[c]) for c in state.columns))

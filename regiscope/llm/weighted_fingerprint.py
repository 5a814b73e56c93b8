"""Fingerprints of documents by consistent weighted sampling, in DataFrame functions alone.

A document's terms are its words, weighted by how often it has them. For sample i, a term k draws
r and c from Gamma(2, 1) and b from [0, 1), all from hashes of (k, i). With weight S it takes the place
t = floor(ln S / r + b) on its grid, and the value a = c exp(-r (t - b + 1)). The smallest value of a
document's terms is its sample; being a function of (k, t) alone, it stands for them. Two documents have
the same sample with the probability of their generalised Jaccard similarity, sum of the smaller
weights over sum of the larger, so the share of equal samples estimates it.

The draws take the logarithm and the exponential from roots and fractions (``_minus_log``, ``_decay``),
good to a hundredth where all but some millionths of the draws are, in less time than the
functions, which are no intrinsics of the JVM, need. A draw is the same wherever its term is, so equal
terms stay equal.

Each document is also compared with the next one by descending id, and with its own text whose
second half is taken from the next. A document and its next one must meet in a task. Quantiles of the
ids cut the documents into ranges, and the first of each range is a guest at the end of the range
before, so one shuffle by range is all that texts go through: the next text, the counts of terms and
the samples are found where the range is, whatever its neighbours do.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 64
# Samples that are drawn in one row.
TOGETHER = 2
# Documents of a range aimed at, and the most ranges there are; beyond, ranges hold more.
RANGE, RANGES = 500, 16_384
# Bounds of ranges that are passed over at once in the search for a document's range.
STRIDE = 64
# Ranges that one id, or no id, may be cut into by the hash of the text.
_PARTS = 1 << 20


def words(text: Column) -> Column:
    """Lower-case words between ASCII white space."""
    return F.array_remove(F.split(F.lower(text), "[ \\t-\\r]+", -1), "")


def _or_empty(found: str) -> Column:
    """The words of a text, or one empty word if it has none."""
    return F.when(F.size(found) == 0, F.array(F.lit(""))).otherwise(F.col(found))


def _below(values: Column, value: Column) -> Column:
    """How many of some ascending values are below a value. No lambda: Spark can tell equal plans by it, and
    so shuffles texts once."""
    return F.array_position(F.sort_array(F.array_append(values, value)), value).cast("int") - 1


def _uniform(hashed: Column, shift: int) -> Column:
    """A number in (0, 1) from 32 bits of a hash."""
    return (F.shiftrightunsigned(hashed, shift).bitwiseAND(F.lit((1 << 32) - 1)) + 0.5) * F.lit(2.0**-32)


def _minus_log(u: Column) -> Column:
    """-ln u of a number in (0, 1): eight times that of its eighth root, by a fraction."""
    s = F.sqrt(F.sqrt(F.sqrt(u)))
    return 24.0 * (1.0 - s * s) / (s * (s + 4.0) + 1.0)


def _decay(w: Column) -> Column:
    """The eighth root of exp(-w), by a fraction."""
    y = w * 0.125
    return (12.0 - y * (6.0 - y)) / (12.0 + y * (6.0 + y))


def _ranges(docs: DataFrame, key: str, per: int) -> Column | None:
    """The range of a row with columns ``id`` and ``tie``; ranges descend with ids. None without rows."""
    spark = docs.sparkSession
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("ids")).first()
    if not size.n:
        return None
    most = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = max(1, min(size.n // per, most, RANGES))
    shares = [k / count for k in range(1, count)]
    bounds = []
    if shares:
        bounds = docs.agg(F.percentile_approx(F.col(key), shares, 20 * count).alias("b")).first().b or []
    values = sorted(set(bounds))
    tie = F.shiftrightunsigned("tie", 1) / float(1 << 63)
    # An id that is several quantiles, or a third of rows without any, is cut by the ties.
    many = [(v, n) for v, n in Counter(bounds).items() if n > 1]
    part = F.lit(0)
    for v, n in many:
        part = F.when(F.col("id") == v, F.floor((1 - tie) * n)).otherwise(part)
    blank = max(1, round(count * (size.n - size.ids) / size.n))
    part = F.when(F.col("id").isNull(), F.floor((1 - tie) * blank)).otherwise(part)
    place = F.lit(0)
    if values:
        all_, coarse = (F.array(*(F.lit(v).cast("long") for v in some)) for some in (values, values[::STRIDE]))
        id_ = F.col("id").cast("long")
        low = F.greatest(_below(coarse, id_) - 1, F.lit(0)) * STRIDE
        place = low + _below(F.slice(all_, low + 1, F.lit(STRIDE)), id_)
    place = F.coalesce(F.when(F.col("id").isNotNull(), place), F.lit(-1))
    return (place.cast("long") * _PARTS - part.cast("long")).alias("range")


def fingerprints(docs: DataFrame, samples: int = SAMPLES, key: str = "doc_id", text: str = "text", per: int = RANGE) -> DataFrame:
    """Per row: ``n_chars``, ``edited_sha256``, both fingerprints, ``near_edited`` and ``near_next``.

    A fingerprint is eight hexadecimal digits for each sample. The edited text has its last
    floor(n_chars / 2) code points replaced by the first as many, or all, of the next document's,
    which is the one with the next smaller id; after the last comes the first, and a single document follows itself.
    Rows without an id come after all others; rows of one id are ordered by a hash of their texts. A NULL text is
    empty. Texts without words are like each other and nothing else. Repeated rows stay. No rows, no result.
    ``samples`` is even.
    """
    if samples % TOGETHER:
        raise ValueError(f"samples must be a multiple of {TOGETHER}")
    number = _ranges(docs, key, per)
    own = docs.select(F.col(key).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    own = own.withColumn("range", F.lit(0).cast("long") if number is None else number).select("range", "id", "tie", "text")
    order = [F.desc("range")]
    first = own.groupBy("range").agg(F.max(F.struct("id", "tie")).alias("head"))
    before = F.lag("range").over(Window.orderBy(*order))
    last = F.last("range").over(Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # One row for each range.
    heads = first.select(F.col("range").alias("_range"), F.coalesce(before, last).alias("host"),
                         F.col("head.id").alias("_id"), F.col("head.tie").alias("_tie"))
    same = (F.col("range") == F.col("_range")) & F.col("id").eqNullSafe(F.col("_id")) & (F.col("tie") == F.col("_tie"))
    guests = own.join(F.broadcast(heads), same).groupBy(F.col("host").alias("range")).agg(
        F.max(F.struct("id", "tie", "text")).alias("row")).select("range", "row.id", "row.tie", "row.text")
    rows = own.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))

    by_range = Window.partitionBy("range").orderBy("guest", F.desc_nulls_last("id"), F.desc("tie"))
    half = F.expr("length(text) div 2")
    edited = F.concat(F.expr("substring(text, 1, cast(length(text) - length(text) div 2 as int))"),
                      F.substring(F.col("next"), F.lit(1), half.cast("int")))
    placed = rows.withColumn("at", F.row_number().over(by_range)).withColumn("next", F.lead("text").over(by_range))
    placed = placed.withColumn("edited", F.when(~F.col("guest"), edited))

    found = placed.select("range", "at", words(F.col("text")).alias("text"), F.when(F.col("edited").isNotNull(), words(F.col("edited"))).alias("edited"))
    terms = found.select("range", "at", F.inline(F.array(
        F.struct(_or_empty("text").alias("words"), F.lit(1).alias("n"), F.lit(0).alias("m")),
        F.struct(F.when(F.col("edited").isNotNull(), _or_empty("edited")).alias("words"), F.lit(0).alias("n"), F.lit(1).alias("m")))))
    terms = terms.select("range", "at", "n", "m", F.explode("words").alias("word")).select("range", "at", F.xxhash64("word").alias("k"), "n", "m")
    counts = terms.groupBy("range", "at", "k").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
    # A term with one weight in both texts is drawn once.
    weights = counts.select("range", "at", "k", F.inline(F.when(F.col("n") == F.col("m"), F.array(
        F.struct(F.col("n").alias("s"), F.lit(True).alias("of_text"), F.lit(True).alias("of_edited")))).otherwise(F.array(
            F.struct(F.col("n").alias("s"), F.lit(True).alias("of_text"), F.lit(False).alias("of_edited")),
            F.struct(F.col("m").alias("s"), F.lit(False).alias("of_text"), F.lit(True).alias("of_edited"))))))
    weights = weights.filter("s > 0").withColumn("w", F.log("s"))
    drawn = weights.select("range", "at", "k", "w", "of_text", "of_edited",
                           F.explode(F.sequence(F.lit(0), F.lit(samples - TOGETHER), F.lit(TOGETHER))).alias("i"))
    for g in range(TOGETHER):
        i = F.col("i") + g
        drawn = drawn.withColumn(f"h{g}", F.xxhash64("k", i)).withColumn(f"j{g}", F.xxhash64("k", i, F.lit(1)))
    for g in range(TOGETHER):
        h, j = F.col(f"h{g}"), F.col(f"j{g}")
        drawn = drawn.withColumn(f"r{g}", _minus_log(_uniform(h, 32) * _uniform(h, 0)))
        drawn = drawn.withColumn(f"c{g}", _minus_log(_uniform(j, 32) * _uniform(j, 0)))
        # Bits across those of the four numbers.
        drawn = drawn.withColumn(f"b{g}", _uniform(F.shiftrightunsigned(h, 16).bitwiseXOR(j), 0))
    for g in range(TOGETHER):
        r, b = F.col(f"r{g}"), F.col(f"b{g}")
        drawn = drawn.withColumn(f"q{g}", _decay(r * (F.floor(F.col("w") / r + b) - b + 1.0)))
    for g in range(TOGETHER):
        q = F.col(f"q{g}")
        drawn = drawn.withColumn(f"q{g}", q * q)
    for g in range(TOGETHER):
        q = F.col(f"q{g}")
        drawn = drawn.withColumn(f"a{g}", F.col(f"c{g}") * (q * q) * (q * q))
    least = drawn.groupBy("range", "at", "i").agg(*(
        F.min(F.when(F.col(of), F.col(f"a{g}"))).alias(f"{of}{g}") for of in ("of_text", "of_edited") for g in range(TOGETHER)))
    # Half as many rows as there are samples meet here for a document.
    some = least.groupBy("range", "at").agg(F.sort_array(F.collect_list(F.struct("i", *(
        F.array(*(f"{of}{g}" for g in range(TOGETHER))).alias(of) for of in ("of_text", "of_edited"))))).alias("s"))
    both = some.select("range", "at", F.flatten("s.of_text").alias("mine"), F.flatten("s.of_edited").alias("theirs"))
    both = both.withColumn("other", F.lead("mine").over(Window.partitionBy("range").orderBy("at")))

    def near(a: str, b: str) -> Column:
        equal = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)
        return F.size(equal) / F.lit(float(samples))

    def digits(values: str) -> Column:
        return F.array_join(F.transform(values, lambda x: F.lower(F.lpad(F.hex(F.shiftrightunsigned(F.xxhash64(x), 32)), 8, "0"))), "")

    found = both.select(F.col("range").alias("_range"), F.col("at").alias("_at"), digits("mine").alias("fingerprint"),
                        digits("theirs").alias("edited_fingerprint"), near("mine", "theirs").alias("near_edited"),
                        near("mine", "other").alias("near_next"))
    known = placed.filter(~F.col("guest")).select("range", "at", "id", F.length("text").cast("long").alias("n_chars"),
                                                  F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    joined = known.join(found, (F.col("range") == F.col("_range")) & (F.col("at") == F.col("_at")))
    return joined.select(F.col("id").alias(key), "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")

"""Column expressions that turn all-text registry fields into typed values.

Everything here is a built-in Column expression, so a whole transform stays in one
generated stage. ``strict=True`` fails the job on a value that does not parse, whatever
the session's ANSI setting; ``strict=False`` gives NULL and leaves the value to
``regiscope.operators.transform.rejects``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How the feed spells "no date", the unknown state, and the id patterns.
NO_DATE = ("", "0", "00000000")
DATE_FORMAT = "yyyyMMdd"
UNKNOWN_STATE = "??"
BASE_ID_PATTERN = r"^[0-9]{8}\z"
CODE_PATTERN = r"^[0-9]+\z"
# The eight characters in which ISO-8859-15 differs from ISO-8859-1.
LATIN1_CHARS = "¤¦¨´¸¼½¾"
LATIN9_CHARS = "€ŠšŽžŒœŸ"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def trim_to_null(c: Column) -> Column:
    return blank_to_null(F.btrim(c))


def zero_to_null(c: Column) -> Column:
    """Blank or a lone ``0`` means absent."""
    return F.nullif(blank_to_null(c), F.lit("0"))


def checked(raw: Column, value: Column, what: str, strict: bool) -> Column:
    """``value``, or in strict mode an error when a present ``raw`` did not parse. A value is worked out once."""
    if not strict:
        return value
    message = F.concat(F.lit(f"cannot read {what} from '"), raw, F.lit("'"))
    return F.coalesce(value, F.when(raw.isNotNull(), F.raise_error(message)))


def to_number(c: Column, type_name: str, strict: bool = True) -> Column:
    """Blank to NULL, then cast to an integer type."""
    raw = blank_to_null(c)
    return checked(raw, raw.try_cast(type_name), type_name, strict)


def to_money(c: Column, strict: bool = True) -> Column:
    """``5000,00`` to decimal(18,2), rounding half up; thousands points do not parse."""
    raw = blank_to_null(c)
    value = F.replace(raw, F.lit(","), F.lit(".")).try_cast("decimal(18,2)")
    return checked(raw, value, "amount", strict)


def parse_date(c: Column, strict: bool = True) -> Column:
    """``AAAAMMDD`` text to date; NULL, blank and all-zero spellings give NULL.

    Eight digits are cast, which takes a fraction of the time of a pattern; anything else goes by the pattern.
    """
    text = F.btrim(c)
    raw = F.when(~text.isin(*NO_DATE), text)
    plain = raw.rlike(r"^[0-9]{8}\z") & ~raw.startswith("0000")
    dashed = F.concat_ws("-", F.substring(raw, 1, 4), F.substring(raw, 5, 2), F.substring(raw, 7, 2))
    value = F.when(plain, dashed.try_cast("date")).otherwise(F.try_to_date(raw, DATE_FORMAT))
    return checked(raw, value, "date", strict)


def yes_no(c: Column) -> Column:
    """``S``/``N`` in either case to a three-valued boolean."""
    letter = F.upper(c)
    return F.when(letter == "S", True).when(letter == "N", False)


def state_or_unknown(c: Column) -> Column:
    return F.coalesce(trim_to_null(c), F.lit(UNKNOWN_STATE))


def phone(area: Column, number: Column) -> Column:
    """Area and number joined; a NULL part makes the whole NULL, a blank part does not."""
    return trim_to_null(F.concat(area, number))


def digits_only(c: Column) -> Column:
    """The digits alone. The usual punctuation goes without a pattern; one takes out what else there is."""
    plain = F.translate(c, "./-", "")
    return F.when(plain.rlike(r"^[0-9]*\z"), plain).otherwise(F.regexp_replace(plain, r"[^0-9]", ""))


def base_id(c: Column) -> Column:
    """First eight characters of a full id."""
    return F.substring(c, 1, 8)


def clip_id(c: Column) -> Column:
    """First fourteen characters: a longer, formatted id is cut, not reformatted."""
    return F.substring(c, 1, 14)


def partnership_id(c: Column, digits: bool = False) -> Column:
    """Id of a silent partnership; ``digits`` strips the punctuation before the cut."""
    present = zero_to_null(c)
    return clip_id(digits_only(present) if digits else present)


def is_base_id(c: Column, pattern: str = BASE_ID_PATTERN) -> Column:
    """Shape test of a base id; the pattern is a parameter because ids may gain letters."""
    return c.rlike(pattern)


def is_code(c: Column) -> Column:
    return c.rlike(CODE_PATTERN)


def has_full_id(c: Column) -> Column:
    return F.length(c) == 14


def not_blank(c: Column) -> Column:
    return blank_to_null(c).isNotNull()


def without(c: Column, characters: str = "\u0000") -> Column:
    """The text without some characters, NUL unless told otherwise."""
    return F.translate(c, characters, "")


def latin1_to_latin9(c: Column) -> Column:
    """Repair text decoded as ISO-8859-1 that was written as ISO-8859-15."""
    return F.translate(c, LATIN1_CHARS, LATIN9_CHARS)


def month_label(path: Column) -> Column:
    """``AAAA-MM`` of the innermost folder of a file's path that carries one, or NULL."""
    return blank_to_null(F.regexp_extract(path, r"^.*[/=]([0-9]{4}-[0-9]{2})[^/]*/", 1))

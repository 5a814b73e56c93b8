"""Trigram similarity of names as Column expressions.

A name is lower-cased and cut into alphanumeric words; each word is padded with two blanks
before and one after, and the distinct three-character pieces form its set. Similarity is
the size of the intersection over the size of the union.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BREAK = r"[^\p{L}\p{N}]+"


def query_trigrams(text: str) -> list[str]:
    """Trigram set of a query string."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    padded = [f"  {w} " for w in words]
    return sorted({p[i : i + 3] for p in padded for i in range(len(p) - 2)})


def implied_trigrams(pattern: str) -> list[str]:
    """Trigrams that every name holding the text has: a word of it may go on beyond either end of the text."""
    text, found = pattern.lower(), set()
    for word in re.finditer(r"[^\W_]+", text):
        padded = "  " * (word.start() > 0) + word.group() + " " * (word.end() < len(text))
        found.update(padded[i : i + 3] for i in range(len(padded) - 2))
    return sorted(found)


def _words(c: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(c), _BREAK, " "))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def _padded(words: Column) -> Column:
    """All words, each behind two blanks and before one. A query trigram occurs in this
    text exactly when it is in the name's set, so membership is a substring test."""
    return F.concat(F.lit("  "), F.replace(words, F.lit(" "), F.lit("  ")), F.lit(" "))


def _pieces(words: Column) -> Column:
    cut = F.transform(
        F.filter(F.split(words, " "), lambda w: w != ""),
        lambda w: F.transform(
            F.sequence(F.lit(1), F.length(w) + 1),
            lambda i: F.substring(F.concat(F.lit("  "), w, F.lit(" ")), i, F.lit(3)),
        ),
    )
    return F.array_distinct(F.flatten(cut))


def trigrams(c: Column) -> Column:
    """Distinct trigrams of a name, as an array."""
    return _pieces(_words(c))


def similarity(c: Column, query: str, needed: int) -> Column:
    """Similarity of a name to a query, NULL for names with fewer than ``needed`` shared trigrams.

    Only the others have their trigram arrays built; a name is normalised once.
    """
    wanted = query_trigrams(query)

    def scored(words: Column) -> Column:
        def of_shared(shared: Column) -> Column:
            return F.when(shared >= needed, shared / (F.size(_pieces(words)) + len(wanted) - shared))

        def count(padded: Column) -> Column:
            return sum((padded.contains(g).cast("int") for g in wanted), F.lit(0))

        return bound(bound(_padded(words), count), of_shared)

    return bound(_words(c), scored)

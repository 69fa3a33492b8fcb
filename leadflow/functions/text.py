"""Text rules: comparison without regard to case and accents, name clean-up, lenient dates.

NULL handling is part of each rule's meaning.  ``keep_null=False`` lets a NULL
fall out of a negative test (three-valued logic); ``keep_null=True`` treats
NULL as the empty text, so it stays.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import DISQUALIFYING_REASONS


def _c(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def _plain(text: str) -> str:
    return "".join(x for x in unicodedata.normalize("NFD", text) if not unicodedata.combining(x))


@lru_cache
def _accents() -> tuple[str, str]:
    """Small Latin letters with accents beside their plain ones; behind them the combining marks, which have none."""
    letters = [chr(i) for i in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00))]
    accented = [x for x in letters if x == x.lower() and x != _plain(x) and len(_plain(x)) == 1]
    return "".join(accented) + "".join(map(chr, range(0x300, 0x370))), "".join(map(_plain, accented))


def fold(column: Column | str) -> Column:
    """The key that texts are compared, grouped and joined by: lower case, no accents, so that José, JOSE and jose are one.

    A plain text, on which Spark hashes and joins as on any other (collated columns can do neither).  Text of ASCII
    letters alone, which has as many bytes as characters, only gets lowered.
    """
    column = _c(column)
    low = F.lower(column)
    return F.when(F.octet_length(column) == F.char_length(column), low).otherwise(
        F.translate(low, *_accents()))


def fold_text(value: str) -> str:
    return _plain(value.lower())


def _folded(column: Column | str, keep_null: bool) -> Column:
    column = _c(column)
    return fold(F.coalesce(column, F.lit(""))) if keep_null else fold(column)


def ci_eq(column: Column | str, value: str) -> Column:
    return fold(column) == fold_text(value)


def ci_ne(column: Column | str, value: str, keep_null: bool = False) -> Column:
    return _folded(column, keep_null) != fold_text(value)


def ci_in(column: Column | str, values: Iterable[str]) -> Column:
    return fold(column).isin([fold_text(v) for v in values])


def ci_not_in(column: Column | str, values: Iterable[str], keep_null: bool = False) -> Column:
    return ~_folded(column, keep_null).isin([fold_text(v) for v in values])


def ci_contains_any(column: Column | str, fragments: Iterable[str]) -> Column:
    low = fold(column)
    return reduce(or_, [low.contains(fold_text(f)) for f in fragments])


def disqualified(reason: Column | str) -> Column:
    """The prospect was turned away for one of the fixed reasons."""
    return ci_contains_any(reason, DISQUALIFYING_REASONS)


def conform_name(column: Column | str) -> Column:
    """Person key: outer blanks off, lower case, NULL stays NULL."""
    return F.trim(F.lower(_c(column)))


def or_empty(column: Column | str) -> Column:
    return F.coalesce(_c(column), F.lit(""))


def to_day(column: Column | str) -> Column:
    """Day of an ISO text such as ``2024-01-02T10:11:12``; bad text gives NULL."""
    return F.substring_index(_c(column), "T", 1).try_cast("date")

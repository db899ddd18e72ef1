"""Parsing of raw feed text: null where the text is not usable."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .money import NAV


def feed_date(raw: Column) -> Column:
    """``dd-mm-yyyy`` text to a date; single digit days and months are accepted."""
    return F.try_to_date(raw, "d-M-yyyy")


def positive_nav(raw: Column) -> Column:
    value = F.trim(raw).try_cast(NAV)
    return F.when(value > 0, value)


def missing(text: Column) -> Column:
    return text.isNull() | (text == "")


def _has_word(name: Column, words: str) -> Column:
    return name.rlike(rf"(?iU)\b({words})\b")


def plan_of(scheme_name: Column) -> Column:
    return F.when(_has_word(scheme_name, "DIRECT"), "Direct").when(_has_word(scheme_name, "REGULAR"), "Regular")


def option_of(scheme_name: Column) -> Column:
    return F.when(_has_word(scheme_name, "GROWTH"), "Growth").when(
        _has_word(scheme_name, "DIVIDEND|IDCW"), "Dividend"
    )


def nav_key(scheme_code: Column, nav_date: Column) -> Column:
    return F.concat_ws(":", scheme_code, F.date_format(nav_date, "yyyy-MM-dd"))


def stable_id(prefix: str, *parts: Column) -> Column:
    """Id that a replay of the same input produces again."""
    texts = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.concat(F.lit(prefix), F.sha2(F.concat_ws("|", *texts), 256))

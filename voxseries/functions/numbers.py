"""Tolerant number expressions. None of them raises under ANSI mode."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxseries.functions.text import strip

_FLOAT_TEXT = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_INT_TEXT = r"^[+-]?\d+$"
_LONG_MOST = 9223372036854775807


def json_text(text: Column, typed: Column, legacy_none: bool = False) -> Column:
    """Text of a JSON value. Booleans are spelled ``True`` and ``False``; null stays null, or
    becomes ``None`` with ``legacy_none``.

    ``text`` is the value as a string and ``typed`` the same value as a variant. The variant is
    only looked at where the string leaves the type open, so it costs nothing on ordinary rows.
    """
    flag = text.isin("true", "false") & (F.schema_of_variant(typed) == "BOOLEAN")
    out = F.when(flag, F.initcap(text))
    if legacy_none:
        out = out.when(text.isNull(), "None")
    return out.otherwise(text)


def _truncate(text: Column) -> Column:
    """Number text to long, toward zero. What a long cannot hold becomes the nearest one it can."""
    number = text.try_cast("double")
    beyond = F.when(F.abs(number) == float("inf"), None).when(number > 0, _LONG_MOST).when(
        number < 0, -_LONG_MOST - 1)
    return F.coalesce(text.try_cast("decimal(38,18)").try_cast("bigint"), beyond)


def _flag(text: Column, typed: Column) -> Column:
    """1 or 0 for a JSON boolean, else null."""
    boolean = text.isin("true", "false") & (F.schema_of_variant(typed) == "BOOLEAN")
    return F.when(boolean, F.when(text == "true", 1).otherwise(0)).cast("bigint")


def to_epoch(text: Column, typed: Column) -> Column:
    """Whole seconds from a JSON number or numeric text, truncated toward zero; else null."""
    bare = strip(text)
    return F.coalesce(F.when(bare.rlike(_FLOAT_TEXT), _truncate(bare)), _flag(text, typed))


def to_score(text: Column, typed: Column) -> Column:
    """Whole number from a JSON value: numbers truncate, integer text parses, all else is 0."""
    bare = strip(text)
    whole = F.when(bare.rlike(_INT_TEXT), _truncate(bare))
    quoted = F.schema_of_variant(typed) == "STRING"
    number = F.when(bare.rlike(_FLOAT_TEXT) & ~quoted, _truncate(bare))
    return F.coalesce(whole, number, _flag(text, typed), F.lit(0).cast("bigint"))


def clean_percent(col: Column, strict: bool = False) -> Column:
    """``"20.10%"`` to 20.1. Tolerant mode gives null for junk; strict mode raises on it."""
    text = F.regexp_replace(strip(col.cast("string")), "[%\u200b]", "")
    return text.cast("double") if strict else text.try_cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; null where the whole is zero."""
    return F.try_divide(part.cast("double"), whole)


def clamp(col: Column, low: float, high: float) -> Column:
    """``col`` held between two bounds. Null stays null, which ``least`` would not ensure."""
    return F.when(col > high, high).when(col < low, low).otherwise(col)


def clamp_abs(col: Column, limit: float = 1.0) -> Column:
    """Absolute value capped at ``limit``."""
    return clamp(F.abs(col), 0.0, limit)

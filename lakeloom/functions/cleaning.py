"""Text-to-type cleaning steps.

Each step is a function ``Column -> Column`` (or builds one), so a vintage can
list its steps declaratively.  Two kinds of cast are kept apart whatever the
session's ANSI setting: a strict cast fails the load on a bad value, a
tolerant cast turns it into NULL and keeps the row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

Step = Callable[[Column], Column]

_INTEGRAL = ("tinyint", "smallint", "int", "integer", "bigint")
_WHOLE = r"^\s*[+-]?[0-9]+\s*$"
_HEX = r"^\s*0[xX][0-9a-fA-F]{1,15}\s*$"
_GROUPED = r"^\s*[+-]?[0-9]+(?:_[0-9]+)+(?:\.[0-9]+)?\s*$"
_DECIMAL = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"
_FLOATING = r"(?i)^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"
_CALENDAR = ("date", "timestamp", "timestamp_ntz")


def _try(column: Column, to: str, mostly_good: bool = False) -> Column:
    """The value as type ``to``, or NULL; texts Spark alone would read differently are told apart.

    An integer cast is quick to read a number and slow to refuse another text,
    so a pattern decides first; values that are ``mostly_good`` go without.
    """
    direct = column.try_cast(to)
    if to in _INTEGRAL:
        # '12.5' and '1e3' are numbers too: they round, halves away from zero.
        rounded = F.round(column.try_cast("decimal(38,18)"), 0).try_cast(to)
        # Digits may be grouped by underscores, and '0x1A' is a number.
        plain = F.replace(column.cast("string"), F.lit("_"), F.lit(""))
        grouped = F.round(plain.try_cast("decimal(38,18)"), 0).try_cast(to)
        hexadecimal = F.conv(F.substring(F.trim(column.cast("string")), 3, 15), 16, 10).try_cast(to)
        other = (
            F.when(column.rlike(_DECIMAL), rounded)
            .when(column.rlike(_GROUPED), grouped)
            .when(column.rlike(_HEX), hexadecimal)
        )
        return F.coalesce(direct, other) if mostly_good else F.when(column.rlike(_WHOLE), direct).otherwise(other)
    if to in _CALENDAR:
        # A year, a month, or an hour without minutes is no point in time.
        # Slashes may stand for dashes.
        text = F.trim(column.cast("string"))
        whole = (F.length(text) >= 8) & (F.contains(text, F.lit(":")) | ~F.contains(text, F.lit(" ")))
        return F.when(whole, F.coalesce(direct, F.replace(text, F.lit("/"), F.lit("-")).try_cast(to)))
    if to == "double":
        # A literal of a programming language such as '1d' or '0x1p3' is no number, 'inf' is one.  The pattern also
        # spares the slow refusal of other texts.
        text = column.cast("string")
        grouped = F.replace(text, F.lit("_"), F.lit("")).try_cast(to)
        return F.when(text.rlike(_FLOATING), direct).when(text.rlike(_GROUPED), grouped)
    return direct


def _refuse(column: Column, kind: str, to: str | None = None) -> Column:
    """Fail on a value that is there but did not parse; reached only then."""
    message = F.concat(F.lit(f"cannot read as {kind}: '"), column, F.lit("'"))
    return F.when(column.isNotNull(), F.raise_error(message).cast(to or kind))


def tolerant(to: str) -> Step:
    """Cast; a value that does not parse or does not fit becomes NULL."""
    return lambda column: _try(column, to)


def strict(to: str) -> Step:
    """Cast; a value that does not parse or does not fit fails the job."""

    def step(column: Column) -> Column:
        return F.coalesce(_try(column, to, mostly_good=True), _refuse(column, to))

    return step


def strip_text(token: str) -> Step:
    """Remove every occurrence of ``token``."""
    return lambda column: F.replace(column, F.lit(token), F.lit(""))


def grouped_int(to: str = "int", separator: str = ",") -> Step:
    """``"1,020"`` -> 1020; anything that is no number -> NULL."""
    return lambda column: _try(F.replace(column, F.lit(separator), F.lit("")), to)


def null_outside(low, high) -> Step:
    """Keep values of the closed range, turn the others into NULL."""
    return lambda column: F.when(column.between(low, high), column)


def map_values(mapping: Mapping[str, object], to: str) -> Step:
    """Coded text to a typed value; a code outside ``mapping`` becomes NULL."""

    def step(column: Column) -> Column:
        result = F.lit(None).cast(to)
        for code, value in reversed(list(mapping.items())):
            result = F.when(column == code, F.lit(value).cast(to)).otherwise(result)
        return result

    return step


def time_of_day(native: bool) -> Step:
    """Strict time of day: TIME where the session has that type, else text.

    The text form is normalised to ``HH:mm:ss`` so that it sorts and compares
    like a time.
    """
    if native:
        return strict("time")

    def step(column: Column) -> Column:
        stamp = F.concat(F.lit("1970-01-01 "), column).try_cast("timestamp_ntz")
        return F.coalesce(F.date_format(stamp, "HH:mm:ss"), _refuse(column, "time", "string"))

    return step


def constant(value, to: str) -> Step:
    """A typed literal whatever the input: a provenance value or a typed NULL."""
    return lambda _column: F.lit(value).cast(to)

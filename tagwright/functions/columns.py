"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

# The characters that count as white space when a contract name
# is stripped (ASCII controls, separators, and the Unicode spaces).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

CHAIN_PREFIX = "eip155:"


def prefixed_hex(binary: Column) -> Column:
    """``0x`` and upper-case hex digits; NULL stays NULL."""
    return F.concat(F.lit("0x"), F.hex(binary))


def packed_hex(text: Column) -> Column:
    """Text as the bytes it stands for, which are half as long and all that a
    shuffle has to move; a text that ``prefixed_hex`` would not give stays text."""
    digits = F.unhex(F.substr(text, F.lit(3)))
    is_hex = prefixed_hex(digits) == text
    return F.struct(
        F.when(is_hex, digits).alias("bytes"), F.when(is_hex, None).otherwise(text).alias("text")
    )


def unpacked_hex(packed: Column) -> Column:
    return F.coalesce(prefixed_hex(packed["bytes"]), packed["text"])


def with_packed_hex(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns, or fields as in ``tags.deployment_tx``, packed in place."""
    return _changed(rows, names, packed_hex)


def with_unpacked_hex(rows: DataFrame, names: Sequence[str]) -> DataFrame:
    return _changed(rows, names, unpacked_hex)


def _changed(
    rows: DataFrame, names: Sequence[str], change: Callable[[Column], Column]
) -> DataFrame:
    for name in names:
        column, _, field = name.partition(".")
        value = change(F.col(name))
        rows = rows.withColumn(column, F.col(column).withField(field, value) if field else value)
    return rows


def stripped(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def chain_ref(chain_id: Column) -> Column:
    return F.concat(F.lit(CHAIN_PREFIX), chain_id.cast("string"))


def has_form(text: Column, prefix: str, length: int) -> Column:
    """True when the text starts with ``prefix`` and has exactly ``length``
    characters; false, not NULL, for a missing text."""
    return F.coalesce(text.startswith(prefix) & (F.length(text) == length), F.lit(False))


def is_address(text: Column) -> Column:
    return has_form(text, "0x", 42)


def is_tx_hash(text: Column) -> Column:
    return has_form(text, "0x", 66)


def percentage(part: Column, whole: Column) -> Column:
    """``part / whole * 100`` as double, 0 where there is nothing to divide by."""
    return F.when(
        whole > 0, part.cast("double") / whole.cast("double") * F.lit(100.0)
    ).otherwise(F.lit(0.0))


def seconds_between(start: Column, end: Column) -> Column:
    """Whole and fractional seconds as double, whatever the session time zone."""
    span = end.cast("timestamp_ntz") - start.cast("timestamp_ntz")
    units = {"DAY": 86400.0, "HOUR": 3600.0, "MINUTE": 60.0, "SECOND": 1.0}
    return sum(
        (F.extract(F.lit(unit), span).cast("double") * F.lit(size) for unit, size in units.items()),
        F.lit(0.0),
    )


def one_line(text: Column) -> Column:
    """Error text for a line-based log: no NULL, no newline."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def folder_name(path: Column) -> Column:
    """Name of the folder that holds the file, i.e. the table name."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def megabytes(size: Column) -> Column:
    return F.bround(size.cast("double") / F.lit(1048576.0), 1)

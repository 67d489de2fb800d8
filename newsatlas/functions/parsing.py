"""Packed dates, loosely typed numbers and delimited text, all safe with ANSI mode on or off.

The dates arrive as integers (``yyyyMMdd``, ``yyyyMMddHHmmss``). Taking them apart with integer
arithmetic is several times cheaper per row than formatting the integer and parsing the text, and
stays inside generated code. The guards below accept what the text patterns accept, but for negative
numbers: no packed date is one, so they are NULL.
Timestamps are read in the session time zone, which the feed expects to be UTC.

Builders that refer to their input many times take it as SQL text (a column name, as a rule) and hand
Spark one expression to parse: building the same tree call by call from Python takes far longer.
"""

from pyspark.sql import Column, functions as F

# Every character Python counts as white space, by rule rather than by list.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

_PLAIN_NUMBER = r"^-?[0-9]+(\.[0-9]+)?$"
_STRICT_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _digits(number: str, skip: int, width: int) -> str:
    """SQL for the ``width`` decimal digits of ``number`` left of its ``skip`` lowest ones."""
    return f"cast({number} div {10**skip} % {10**width} AS int)"


def feed_date(packed: str) -> Column:
    """``yyyyMMdd`` integer to DATE; NULL when it is not a real eight-digit date."""
    n = f"try_cast({packed} AS bigint)"
    return F.expr(
        f"CASE WHEN {n} BETWEEN 10000000 AND 99999999 THEN cast(try_make_timestamp_ntz("
        f"{_digits(n, 4, 4)}, {_digits(n, 2, 2)}, {_digits(n, 0, 2)}, 0, 0, 0) AS date) END"
    )


def _timestamp_of(n: str) -> Column:
    seconds = _digits(n, 0, 2)
    # Sixty seconds would roll over to the next minute instead of failing.
    return F.expr(
        f"CASE WHEN {n} >= 0 AND {n} < {10**14} AND {seconds} < 60 THEN try_make_timestamp("
        f"{_digits(n, 10, 4)}, {_digits(n, 8, 2)}, {_digits(n, 6, 2)}, "
        f"{_digits(n, 4, 2)}, {_digits(n, 2, 2)}, cast({seconds} AS decimal(16,6))) END"
    )


def feed_timestamp(packed: str) -> Column:
    """``yyyyMMddHHmmss`` integer to TIMESTAMP; NULL when unreal or longer than 14 digits."""
    return _timestamp_of(f"try_cast({packed} AS bigint)")


def feed_timestamp_prefix(packed: str) -> Column:
    """As :func:`feed_timestamp`, but digits after the fourteenth are ignored instead of fatal."""
    n = f"try_cast({packed} AS bigint)"
    # Only over-long values take the way through text.
    shortened = f"try_cast(substr(cast({n} AS string), 1, 14) AS bigint)"
    return _timestamp_of(f"(CASE WHEN {n} < {10**14} THEN {n} ELSE {shortened} END)")


def feed_year(packed: Column) -> Column:
    """First four digits of a packed date, as INT."""
    return packed.cast("string").substr(1, 4).try_cast("int")


def day_text(date: Column) -> Column:
    """DATE as ``yyyy-MM-dd`` text."""
    return F.date_format(date, "yyyy-MM-dd")


def mention_time_text(moment: Column) -> Column:
    """TIMESTAMP as ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def slice_start(moment: Column, delay_hours: int = 6, minutes: int = 15) -> Column:
    """Start of the feed slice that is complete at ``moment``: delayed, then floored."""
    step = minutes * 60
    delayed = F.unix_timestamp(moment) - F.lit(delay_hours * 3600)
    return F.timestamp_seconds(delayed - F.pmod(delayed, F.lit(step)))


def trim_all(text: Column) -> Column:
    """Strip every Unicode white-space character from both ends, not only spaces."""
    return F.trim(text, F.lit(WHITESPACE))


def not_blank(text: Column) -> Column:
    """True for text that holds more than spaces; NULL for NULL, so a filter drops it."""
    return F.trim(text) != ""


def number_text(text: Column) -> Column:
    """Coordinate text to DOUBLE; NULL for anything but plain ``-digits.digits``."""
    trimmed = F.trim(text)
    return F.when(trimmed.rlike(_PLAIN_NUMBER), trimmed.try_cast("double"))


def strict_number(value: Column) -> Column:
    """Any value to DOUBLE when the whole of it is a number; blanks and dates are NULL."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(_STRICT_NUMBER), text.try_cast("double"))


def safe_float(value: Column) -> Column:
    """Value to DOUBLE, or NULL when it cannot be read as one."""
    return value.try_cast("double")


def delimited(text: Column, separator: str = ";") -> Column:
    """Split on a one-character separator; a trailing separator yields a last blank item."""
    return F.split(text, separator)


def field(item: Column, position: int, separator: str = "#") -> Column:
    """The ``position``-th (1-based) field of an item, NULL when there are fewer."""
    return F.try_element_at(F.split(item, separator), F.lit(position))


def leading_item(text: Column) -> Column:
    """Trimmed text before the first comma; blank when it starts with one."""
    return F.regexp_extract(F.trim(text), "^([^,]+)", 1)

"""Text-to-number rules for external input."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Decimal literal, infinity or NaN, with optional sign, blanks around it and single
# underscores between digits. Rejects what Spark's cast would take on top of that
# (type suffixes such as 1d, hexadecimal floats).
_DIGITS = r"\d+(?:_\d+)*"
_FLOAT = (
    rf"(?i)^\s*[+-]?(?:(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf(?:inity)?|nan)\s*$"
)
# Characters of an ordinary literal. Over these alone the cast accepts the same texts.
_ORDINARY = r"^[0-9.+eE-]+$"
_INTEGER = rf"^\s*[+-]?{_DIGITS}\s*$"


def lenient_double(text: Column) -> Column:
    """Text as a double; missing, empty or unreadable text is 0.0.

    Ordinary literals pass one cheap test; the full pattern runs on what is left.
    """
    plain = F.regexp_replace(text, r"[_\s]", "")
    unsigned_nan = F.regexp_replace(plain, r"(?i)^[+-](?=nan$)", "")
    return F.coalesce(
        F.when(text.rlike(_ORDINARY), text.try_cast("double")),
        F.when(text.rlike(_FLOAT), unsigned_nan.try_cast("double")),
        F.lit(0.0),
    )


def _integer(text: Column) -> Column:
    return F.regexp_replace(text, r"[_\s]", "").try_cast("int")


def routing_label(text: Column) -> Column:
    """Label used to pick a scenario: anything unreadable counts as 0."""
    return F.coalesce(F.when(text.rlike(_INTEGER), _integer(text)), F.lit(0))


def is_bad_label(text: Column) -> Column:
    """True for text that :func:`strict_label` refuses; never NULL."""
    return F.coalesce((text != "") & ~text.rlike(_INTEGER), F.lit(False))


def strict_label(text: Column) -> Column:
    """Label as stored: missing or empty is 0, unreadable text fails the job.

    The failure is raised explicitly, so it does not depend on ANSI mode. An integer
    too large for the column is NULL, as it is when the message is decoded.
    """
    return (
        F.when(text.isNull() | (text == ""), F.lit(0))
        .when(text.rlike(_INTEGER), _integer(text))
        .otherwise(F.raise_error(F.concat(F.lit("unreadable label: "), text)).cast("int"))
    )


def lenient_label(text: Column) -> Column:
    """Like :func:`strict_label`, but unreadable text is NULL; see :func:`is_bad_label`."""
    return F.when(text.isNull() | (text == ""), F.lit(0)).when(
        text.rlike(_INTEGER), _integer(text)
    )


def csv_field_count(line: Column) -> Column:
    """Number of comma-separated fields in a raw line, quoted commas not counted.

    A comma is put in front so that every field, the empty ones too, starts with one.
    """
    field_pattern = r',(?:"[^"]*+(?:""[^"]*+)*+(?:"[^,]*|$)|[^,"][^,]*|)'
    return F.regexp_count(F.concat(F.lit(","), line), F.lit(field_pattern))


def has_unclosed_quote(line: Column) -> Column:
    """Whether a field of a raw line opens a quote that the line does not close."""
    closed = r'\G,(?:"[^"]*+(?:""[^"]*+)*+"[^,]*|[^,"][^,]*|(?=,|$))'
    return F.regexp_replace(F.concat(F.lit(","), line), closed, "").startswith(',"')

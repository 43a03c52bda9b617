"""File text: strict JSON check, content tag, names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Options that switch off the reader's leniency towards non-standard JSON.
STRICT = {"allowNonNumericNumbers": "false", "allowSingleQuotes": "false"}


def content_tag(value: Column) -> Column:
    """Content hash used as etag where the object store gave none."""
    return F.md5(value)


def sealed(value: Column, document: str = "") -> Column:
    """Parse ``[<value>,{"seal":"<hash of value>"}]`` to an array of structs.

    Spark's JSON parsers stop after the first complete value and ignore what
    follows. With the hash in a closing element, the array has exactly two
    elements and ends in the hash only if ``value`` is one complete JSON value:
    a stray bracket closes the array early, a second value makes it longer, and
    no text can contain its own hash. A value that is no object gives null.

    ``document`` names the fields to read as ``name:type`` pairs.
    """
    wrapped = F.concat(F.lit("["), value, F.lit(',{"seal":"'), F.md5(value), F.lit('"}]'))
    fields = f"seal:string,{document}" if document else "seal:string"
    return F.from_json(wrapped, f"array<struct<{fields}>>", STRICT)


def is_intact(parsed: Column, value: Column) -> Column:
    """Whether ``sealed(value)`` holds one JSON object and nothing else."""
    whole = (F.size(parsed) == 2) & (F.get(parsed, 1)["seal"] == F.md5(value))
    return F.coalesce(whole & F.get(parsed, 0).isNotNull(), F.lit(False))


def base_name(path: Column) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(path, "/"), -1)


def plain_path(path: Column) -> Column:
    """One spelling per file: ``s3a``/``s3n`` become ``s3``, ``file:///x`` becomes ``file:/x``."""
    path = F.regexp_replace(path, "^s3[an]://", "s3://")
    path = F.regexp_replace(path, "^/", "file:/")
    return F.regexp_replace(path, "^file:/+", "file:/")


def iso_instant(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP, null where it is none; without an offset it is UTC.

    Spark also reads a bare time of day and would add today's date, so a full
    date is asked for. A text that has an offset cannot be read with a second one.
    """
    dated = (F.substring(text, 5, 1) == "-") & (F.substring(text, 8, 1) == "-")
    time = F.substring(text, 12, 64)
    zoned = time.contains("+") | time.contains("-") | time.endswith("Z")  # the usual case: one parse
    as_utc = [F.try_to_timestamp(F.concat(text, F.lit(end))) for end in ("Z", "T00:00:00Z")]
    plain = F.try_to_timestamp(text)
    return F.when(dated, F.when(zoned, plain).otherwise(F.coalesce(*as_utc, plain)))


def utc_day(instant: Column) -> Column:
    """Calendar day of an instant in UTC, whatever the session's zone."""
    seconds = F.unix_seconds(instant)
    return F.date_from_unix_date(((seconds - F.pmod(seconds, F.lit(86400))) / 86400).cast("int"))

"""Payload access, row by row, on a VARIANT payload."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from siltstone.schemas import CONTRACT


def as_map(payload: Column) -> Column:
    """An object payload as field name to variant; null for any other kind."""
    return F.try_variant_get(payload, "$", "map<string,variant>")


def as_text(payload: Column) -> Column:
    """A payload as JSON text. Every string in it costs a JSON writer, so ask for it only where it is needed."""
    return F.to_json(payload)


def _found(payload: Column, name: str) -> Column:
    return F.try_variant_get(payload, f"$.{name}", "string")


def _or_from_json(odd: Column, text: Column, payload: Column, name: str) -> Column:
    """``text``, or where ``odd`` what the payload's JSON gives; lists and objects are always odd."""
    whole = F.try_element_at(F.from_json(as_text(payload), "map<string,string>"), F.lit(name))
    return F.when(odd | F.substring(text, 1, 1).isin("{", "["), whole).otherwise(text)


def field(payload: Column, name: str) -> Column:
    """Text of a field of an object payload, as its JSON is read; null where absent or JSON null.

    A lookup gives the same text, but for numbers with a fraction or an exponent.
    """
    text = _found(payload, name)
    fraction = F.substring(text, 1, 1).isin("-", *"0123456789") & (text.contains(".") | text.contains("E"))
    return _or_from_json(fraction, text, payload, name)


def number(payload: Column, name: str) -> Column:
    """``field`` where only the number counts: up to 15 digits are the same in any spelling."""
    text = _found(payload, name)
    return _or_from_json(F.length(text) > 15, text, payload, name)


def kind(payload: Column, fields: Column) -> Column:
    """``null``, ``string``, ``object`` or ``other``; an absent payload counts as null.

    ``fields`` is the payload's ``as_map``.
    """
    text = as_text(payload)
    return (
        F.when(fields.isNotNull(), "object")
        .when(payload.isNull() | (text == "null"), "null")
        .when(text.startswith('"'), "string")
        .otherwise("other")
    )


def unexpected(event_type: Column, names: Column) -> Column:
    """Names outside the contract of the row's own domain; null for unknown domains."""
    found = F.lit(None).cast("array<string>")
    for domain, allowed in CONTRACT.items():
        extra = F.array_except(names, F.array(*[F.lit(n) for n in allowed]))
        found = F.when(event_type == domain, extra).otherwise(found)
    return found


def money(text: Column) -> Column:
    """Text to DECIMAL(10,2), null unless it is a number >= 0 that fits.

    The sign is taken from the number as sent: -0.001 rounds to 0.00 as decimal.
    """
    return F.when(text.try_cast("double") >= 0, text.try_cast("decimal(10,2)"))

"""Typed access to the JSON columns of products, feeds and import states."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

VARIANTS = ("vault", "boost")


def variant_field(data: Column, name: str, variants: tuple[str, ...] = VARIANTS) -> Column:
    """First variant that has the field: the vault's, else the boost's."""
    return F.coalesce(*[F.get_json_object(data, f"$.{v}.{name}") for v in variants])


def is_true(data: Column, path: str) -> Column:
    return F.get_json_object(data, path) == F.lit("true")


def display_id(data: Column) -> Column:
    return variant_field(data, "id")


def is_eol(data: Column) -> Column:
    return variant_field(data, "eol") == F.lit("true")


def contract_address(data: Column) -> Column:
    return F.lower(variant_field(data, "contract_address"))


def pretty(data: Column) -> Column:
    return F.to_json(F.parse_json(data), {"pretty": "true"})


def drop_id_fields(data: Column) -> Column:
    """JSON object without the top-level fields whose name ends in ``Id``."""
    fields = F.from_json(data, "map<string,variant>")
    return F.to_json(F.map_filter(fields, lambda k, _: ~k.endswith("Id")))


def fields_as_text(text: Column) -> Column:
    """The fields of a JSON object, each value as JSON text."""
    parsed = F.from_json(text, "map<string,variant>")
    return F.transform_values(parsed, lambda _, v: F.coalesce(F.to_json(v), F.lit("null")))


def append_json(left: Column, right: Column) -> Column:
    """A JSON array with the elements of another, or with anything else as one more element."""
    def inner(text: Column) -> Column:
        return text.substr(F.lit(2), F.length(text) - 2)

    inner_left, inner_right = inner(left), F.when(right.startswith("["), inner(right)).otherwise(right)
    parts = F.filter(F.array(inner_left, inner_right), lambda x: F.trim(x) != F.lit(""))
    return F.concat(F.lit("["), F.concat_ws(",", parts), F.lit("]"))

"""Conservative access to VARIANT payloads: a value of the wrong type is null, never coerced."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions.cols import ColumnLike, col


def parse(text: ColumnLike) -> Column:
    return F.try_parse_json(col(text))


def get(value: ColumnLike, path: str) -> Column:
    """Sub-value as VARIANT; SQL null when the path is absent."""
    return F.try_variant_get(col(value), path, "variant")


def present(value: ColumnLike, path: str) -> Column:
    """The path exists, be it with a JSON null; no object or list is copied to find out."""
    return is_object(value, path) | is_list(value, path) | get(value, path).isNotNull()


def as_list(value: ColumnLike, path: str = "$") -> Column:
    return F.try_variant_get(col(value), path, "array<variant>")


def as_object(value: ColumnLike, path: str = "$") -> Column:
    return F.try_variant_get(col(value), path, "map<string,variant>")


def is_object(value: ColumnLike, path: str = "$") -> Column:
    """An object; no member is copied to find out."""
    return F.try_variant_get(col(value), path, "struct<>").isNotNull()


def is_list(value: ColumnLike, path: str = "$") -> Column:
    """A list; no element is copied to find out."""
    return F.try_variant_get(col(value), path, "array<struct<>>").isNotNull()


def members(value: ColumnLike) -> Column:
    """The keys of an object as a map without values; no member is copied."""
    return F.try_variant_get(col(value), "$", "map<string,struct<>>")


def elements(value: ColumnLike, path: str = "$") -> Column:
    """A list without what its elements hold; no element is copied."""
    return F.try_variant_get(col(value), path, "array<struct<>>")


def has_nested(value: ColumnLike) -> Column:
    """An object with a member that is an object or a list; no member is copied to find out."""
    lists = F.try_variant_get(col(value), "$", "map<string,array<struct<>>>")
    held = [F.exists(F.map_values(found), lambda m: m.isNotNull()) for found in (members(value), lists)]
    return F.coalesce(held[0] | held[1], F.lit(False))


def nested_entries(value: ColumnLike) -> Column:
    """Entries of an object whose values are objects or lists."""
    return F.filter(F.map_entries(as_object(value)), lambda e: is_object(e["value"]) | is_list(e["value"]))


def text(value: ColumnLike, path: str) -> Column:
    """String value; null unless the JSON value is a string."""
    node = get(value, path)
    return F.when(F.schema_of_variant(node) == "STRING", F.try_variant_get(col(value), path, "string"))


def nonempty(value: ColumnLike, path: str) -> Column:
    return F.nullif(text(value, path), F.lit(""))


def integer(value: ColumnLike, path: str) -> Column:
    """Integer value; booleans, decimals and numeric strings are not integers."""
    node = get(value, path)
    return F.when(F.schema_of_variant(node) == "BIGINT", F.try_variant_get(col(value), path, "bigint"))


def positive(value: ColumnLike, path: str) -> Column:
    number = integer(value, path)
    return F.when(number > 0, number)


def scalar_text(value: ColumnLike, path: str) -> Column:
    """String or number as trimmed text; null for blanks, booleans and nested values."""
    node = get(value, path)
    kind = F.schema_of_variant(node)
    usable = (kind == "STRING") | (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    return F.when(usable, F.nullif(F.trim(F.try_variant_get(col(value), path, "string")), F.lit("")))


def number(value: ColumnLike, path: str) -> Column:
    kind = F.schema_of_variant(get(value, path))
    usable = (kind == "BIGINT") | (kind == "DOUBLE") | kind.startswith("DECIMAL")
    return F.when(usable, F.try_variant_get(col(value), path, "double"))


def canonical(value: ColumnLike) -> Column:
    """JSON text with sorted keys."""
    return F.to_json(col(value))


def table_text(value: ColumnLike, path: str = "$") -> Column:
    """Rectangular list of scalar rows as text: cells by `` | ``, rows by newline."""
    rows = F.try_variant_get(col(value), path, "array<array<variant>>")
    nested = F.exists(
        rows,
        lambda row: row.isNull()
        | F.exists(row, lambda cell: F.schema_of_variant(cell).rlike("^(OBJECT|ARRAY)")),
    )
    widths = F.array_distinct(F.transform(rows, lambda row: F.size(row)))

    def cell_text(cell: Column) -> Column:
        # JSON null is an empty cell; booleans keep the capitalised spelling of the source data.
        kind = F.schema_of_variant(cell)
        shown = F.try_variant_get(cell, "$", "string")
        return F.when(kind == "VOID", F.lit("")).when(kind == "BOOLEAN", F.initcap(shown)).otherwise(shown)

    lines = F.transform(
        rows, lambda row: F.array_join(F.transform(row, lambda c: F.coalesce(cell_text(c), F.lit(""))), " | ")
    )
    good = (F.size(rows) > 0) & ~nested & (F.size(widths) == 1) & (F.element_at(widths, 1) > 0)
    return F.when(good, F.array_join(lines, "\n"))


def array_length(text_column: ColumnLike) -> Column:
    """Length of a JSON array held as text; 0 when it is not one."""
    return F.coalesce(F.json_array_length(col(text_column)), F.lit(0))

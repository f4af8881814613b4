"""Deterministic identifiers as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions.cols import ColumnLike, col, let

# Fixed value: the RFC 4122 namespace for URL names.
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def uuid5(name: ColumnLike) -> Column:
    """Name-based UUID (version 5, URL namespace) of a string column."""
    return let(F.sha1(F.concat(F.unhex(F.lit(URL_NAMESPACE)), col(name).cast("binary"))), _uuid_text)


def _uuid_text(digest: Column) -> Column:
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def packed_hash(value: ColumnLike) -> Column:
    """The 16 bytes of a lower-case md5; any other text keeps its bytes behind 17 zeros, so that different texts stay different."""
    text = col(value)
    shaped = text.rlike(r"\A[0-9a-f]{32}\z")
    other = F.concat(F.unhex(F.lit("00" * 17)), F.encode(text, "UTF-8"))
    return F.when(shaped, F.unhex(text)).otherwise(other)


def json_string(value: ColumnLike) -> Column:
    """A string rendered as one JSON token (quoted and escaped), or ``null``."""
    text = col(value).cast("string")
    listed = F.to_json(F.array(text))
    # Printable ASCII without quotes and backslashes needs no escape.
    return F.when(text.rlike(r"\A[ !#-\[\]-~]*\z"), F.concat(F.lit('"'), text, F.lit('"'))).otherwise(F.substring(listed, F.lit(2), F.length(listed) - 2))


def evidence_id(*parts: Column | str | int | None) -> Column:
    """uuid5 over the JSON list of the parts; plain strings are literals, integers stay unquoted."""
    rendered = []
    for part in parts:
        if part is None:
            rendered.append(F.lit("null"))
        elif isinstance(part, int):
            rendered.append(F.lit(str(part)))
        elif isinstance(part, str):
            rendered.append(json_string(F.lit(part)))
        else:
            rendered.append(part)
    return uuid5(F.concat(F.lit("["), F.concat_ws(", ", *rendered), F.lit("]")))


def text_part(value: ColumnLike) -> Column:
    return json_string(value)


def number_part(value: ColumnLike) -> Column:
    return F.coalesce(col(value).cast("string"), F.lit("null"))


def number_text(value: ColumnLike) -> Column:
    """A double in the shortest spelling with an exponent only below 1e-4 and from 1e16 on, two digits at least."""
    text = col(value).cast("double").cast("string")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    whole, part = F.regexp_extract(text, r"(\d+)\.", 1), F.regexp_extract(text, r"\.(\d+)", 1)
    part = F.when(part == "0", "").otherwise(part)
    power = F.regexp_extract(text, r"E(-?\d+)", 1).try_cast("int")
    digits = F.concat(whole, part)
    moved = F.concat(F.rpad(digits, power + 1, "0"), F.lit("."), F.greatest(F.substring(digits, power + 2, F.length(digits)), F.lit("0")))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), digits)
    exponent = F.concat(
        whole, F.when(part == "", "").otherwise(F.concat(F.lit("."), part)), F.when(power < 0, "e-").otherwise("e+"),
        F.lpad(F.abs(power).cast("string"), F.greatest(F.lit(2), F.length(F.abs(power).cast("string"))), F.lit("0")),
    )
    shown = F.when((power >= 0) & (power < 16), moved).when((power < 0) & (power >= -4), small).otherwise(exponent)
    return F.when(power.isNull(), text).otherwise(F.concat(sign, shown))


def dumped(df: DataFrame) -> Column:
    """A flat row as JSON in the spelling that content ids hash: sorted keys, a space after colons and commas, dates as text.

    Columns may be texts, booleans, numbers, dates, times and lists of texts.
    """
    def value(field: T.StructField) -> Column:
        own = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.ArrayType):
            shown = F.concat(F.lit("["), F.array_join(F.transform(own, json_string), ", "), F.lit("]"))
        elif isinstance(field.dataType, T.DoubleType | T.FloatType):
            shown = number_text(own)
        elif isinstance(field.dataType, T.NumericType | T.BooleanType):
            shown = own.cast("string")
        else:
            shown = json_string(own)
        return F.concat(json_string(F.lit(field.name)), F.lit(": "), F.coalesce(shown, F.lit("null")))

    fields = sorted(df.schema.fields, key=lambda f: f.name)
    return F.concat(F.lit("{"), F.concat_ws(", ", *[value(f) for f in fields]), F.lit("}"))


def positional_hash(*parts: ColumnLike) -> Column:
    """md5 of the positional JSON list: nulls keep their place, delimiters are escaped."""
    return F.md5(F.to_json(F.array(*[col(p).cast("string") for p in parts])))


def joined_hash(*parts: ColumnLike) -> Column:
    """md5 of the ``|``-joined parts; null parts are skipped."""
    return F.md5(F.concat_ws("|", *[col(p) for p in parts]))


def candidate_id(name: ColumnLike) -> Column:
    return F.concat(F.lit("candidate-"), F.substring(F.sha2(F.lower(F.trim(col(name))), 256), 1, 24))


def request_hash(fields: dict[str, Column]) -> Column:
    """sha256 of the key-sorted compact JSON of every result-affecting field."""
    ordered = [fields[key].alias(key) for key in sorted(fields)]
    return F.sha2(F.to_json(F.struct(*ordered), {"ignoreNullFields": "false"}), 256)


def deduplication_key(*parts: ColumnLike) -> Column:
    return F.sha2(F.concat_ws("\x1f", *[col(p) for p in parts]), 256)

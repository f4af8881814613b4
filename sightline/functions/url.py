"""URL functions. Regular expressions, because URI parsing rejects hosts the data contains."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions.cols import ColumnLike, col, let

# Fixed value: scheme, host without user-info, optional port, then path, query or end.
AUTHORITY = r"^(?i:(https?))://(\[[^\]]+\]|[^/?#:@\s]+)(?::(\d*))?(?=[/?#]|$)"


def _with_scheme(value: Column) -> Column:
    return F.when(value.contains("://"), value).otherwise(F.concat(F.lit("https://"), value))


def _lowered(host: Column) -> Column:
    """Full lower case; letters that are all small ASCII already are left as they are."""
    return F.when(host.rlike(r"[^\x00-@\[-\x7f]"), F.lower(host)).otherwise(host)


def hostname(value: ColumnLike) -> Column:
    """Lower-case host of an http(s) URL or bare host; null for anything unsafe."""
    def of(text: Column) -> Column:
        host = F.regexp_extract(_with_scheme(text), AUTHORITY, 2)
        host = F.rtrim(F.regexp_replace(host, r"^\[|\]$", ""), F.lit("."))
        return F.when(F.length(F.trim(text)) > 0, let(host, lambda h: F.when(h != "", _lowered(h))))

    return of(F.col(value)) if isinstance(value, str) else let(value, of)


def canonical_url(value: ColumnLike) -> Column:
    """Entity identity of a URL: lower scheme and host, no default port, no fragment."""
    def usable(text: Column) -> Column:
        parts = F.struct(
            text.alias("text"), hostname(text).alias("host"), F.lower(F.regexp_extract(text, AUTHORITY, 1)).alias("scheme"),
            F.regexp_extract(text, AUTHORITY, 3).alias("port"),
        )
        return F.when(text.startswith("http://") | text.startswith("https://"), let(parts, _canonical))

    return let(col(value), usable)


def _canonical(parts: Column) -> Column:
    text, host, scheme, port = [parts[n] for n in ("text", "host", "scheme", "port")]
    number = port.try_cast("int")
    rest = F.regexp_replace(
        F.regexp_replace(text, r"^[^:]+://[^/?#]*", ""), r"#.*$", ""
    )
    # An empty path becomes "/", also in front of a query.
    rest = let(rest, lambda r: F.when(r.startswith("/"), r).otherwise(F.concat(F.lit("/"), r)))
    shown_port = F.when(
        (F.length(port) == 0)
        | (number == 0)
        | ((scheme == "http") & (number == 80))
        | ((scheme == "https") & (number == 443)),
        F.lit(""),
    ).otherwise(F.concat(F.lit(":"), number.cast("string")))
    shown_host = F.when(host.contains(":"), F.concat(F.lit("["), host, F.lit("]"))).otherwise(host)
    trimmed_query = F.regexp_replace(rest, r"\?$", "")
    return F.when(
        host.isNotNull() & ((F.length(port) == 0) | (number <= 65535)),
        F.concat(scheme, F.lit("://"), shown_host, shown_port, trimmed_query),
    )


def legacy_canonical_url(value: ColumnLike) -> Column:
    """First-generation form: lower scheme and authority, keep the port, drop the fragment."""
    text = col(value)
    head = F.regexp_extract(text, r"^(?i:https?)://[^/?#]+", 0)
    tail = F.regexp_replace(F.substring(text, F.length(head) + 1, F.length(text)), r"#.*$", "")
    return F.when(F.length(head) > 0, F.concat(F.lower(head), F.regexp_replace(tail, r"\?$", "")))


def url_host(value: ColumnLike) -> Column:
    """Host part of any URL with an authority (user-info and port removed), lower case."""
    authority = F.regexp_extract(col(value), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":\d*$", "")
    return F.nullif(F.lower(F.regexp_replace(host, r"^\[|\]$", "")), F.lit(""))


def normalized_domain(domain: ColumnLike, url: ColumnLike) -> Column:
    candidate = F.coalesce(F.nullif(col(domain), F.lit("")), url_host(url))
    return F.rtrim(F.lower(candidate), F.lit("."))


def host_suffixes(host: ColumnLike) -> Column:
    """The host and every parent domain: ``a.b.c`` gives ``a.b.c``, ``b.c``, ``c``."""
    parts = F.split(col(host), "[.]")
    return F.transform(
        F.sequence(F.lit(1), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."),
    )

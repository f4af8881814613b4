"""Text functions: trimming, placeholders, link removal, term spans."""

from __future__ import annotations

import unicodedata
from bisect import bisect_right
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.functions.cols import ColumnLike, any_of, col
from sightline.schemas import PLACEHOLDER_MARKS

# Patterns that decide what counts as a link or a word.
MARKDOWN_LINK = r"\[([^\]]*)\]\((https?://[^)]+)\)"
ANY_MARKDOWN_LINK = r"\[([^\]]*)\]\([^)]*\)"
BARE_URL = r"<?https?://[^\s<>]+>?"
WORD = r"[\p{L}\p{N}_]+"
WORD_CHAR = r"[\p{L}\p{N}_]"
SYMBOL = r"[^\p{L}\p{N}_\s]"
CJK = r"[㐀-鿿぀-ヿ가-힯]"
SECRET_PARAMETER = r"(?i)([?&](?:api[_-]?key|token|access_token|password|secret)=)[^&#\s]*"
SECRET_JSON_PARAMETER = (
    r"(?i)([?&](?:api[_-]?key|token|access_token|password|secret)=)"
    r'(?:[^&#\s"\\]|\\["\\/b]|\\u(?!00(?:09|0[a-d]|20|85|a0))[0-9a-f]{4})*+'
)
UNKNOWN_LABEL = "Unknown (not recorded)"


def nullif_trim(value: ColumnLike) -> Column:
    trimmed = F.trim(col(value).cast("string"))
    return F.nullif(trimmed, F.lit(""))


def normalize_language(value: ColumnLike) -> Column:
    return F.nullif(F.lower(F.replace(F.trim(col(value).cast("string")), F.lit("_"), F.lit("-"))), F.lit(""))


def display(value: ColumnLike) -> Column:
    return F.coalesce(col(value).cast("string"), F.lit(UNKNOWN_LABEL))


def is_placeholder(*values: ColumnLike) -> Column:
    """True when any value carries a placeholder marker; null values never do."""
    hits = [
        F.coalesce(F.lower(col(v).cast("string")).contains(mark), F.lit(False))
        for v in values
        for mark in PLACEHOLDER_MARKS
    ]
    return any_of(*hits)


def visible_text(value: ColumnLike) -> Column:
    """Link labels stay, link targets and bare URLs go."""
    return F.regexp_replace(F.regexp_replace(col(value), MARKDOWN_LINK, "$1"), BARE_URL, "")


def label_text(value: ColumnLike) -> Column:
    """Link labels stay; bare URLs are left alone (first-generation rule)."""
    return F.regexp_replace(col(value), ANY_MARKDOWN_LINK, "$1")


def inline_links(value: ColumnLike) -> Column:
    """array<struct<index, label, url>> of the markdown links of a text."""
    labels = F.regexp_extract_all(col(value), F.lit(MARKDOWN_LINK), F.lit(1))
    urls = F.regexp_extract_all(col(value), F.lit(MARKDOWN_LINK), F.lit(2))
    zipped = F.arrays_zip(labels.alias("label"), urls.alias("url"))
    return F.transform(
        zipped,
        lambda x, i: F.struct(i.alias("index"), x["label"].alias("label"), x["url"].alias("url")),
    )


def redact_parameters(value: ColumnLike) -> Column:
    return F.regexp_replace(col(value), SECRET_PARAMETER, "$1[REDACTED]")


def redact_json_parameters(value: ColumnLike) -> Column:
    """The same inside JSON text: a parameter ends with its string at the latest; escaped characters belong to it."""
    return F.regexp_replace(col(value), SECRET_JSON_PARAMETER, "$1[REDACTED]")


def words(folded: ColumnLike) -> Column:
    """Distinct anchors of a folded text: its words and its single CJK characters."""
    text = col(folded)
    tokens = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.array_distinct(
        F.when(
            text.rlike(CJK),
            F.concat(tokens, F.regexp_extract_all(text, F.lit(CJK), F.lit(0))),
        ).otherwise(tokens)
    )


def is_cjk(term: ColumnLike) -> Column:
    return col(term).rlike(CJK)


def anchor(folded_term: ColumnLike) -> Column:
    """The one word (or CJK character) any text containing the term must contain.

    A Latin term only matches between word boundaries, so its first word is a whole word of the
    text. A term with a CJK character may start inside a run, but that character is in the text.
    """
    term = col(folded_term)
    return F.when(is_cjk(term), F.regexp_extract(term, CJK, 0)).otherwise(
        F.nullif(F.regexp_extract(term, WORD, 0), F.lit(""))
    )


@cache
def _in_word(letter: str) -> bool:
    return letter == "_" or unicodedata.category(letter)[0] in "LN"


def spans_of(text: str, folded: str, extra: list[int], terms: list[dict]) -> list[tuple[str, int, int, str]]:
    """(identity, start, end, matched text) of all boundary-respecting occurrences of the terms in a text.

    Needles are folded, offsets those of the original text (end exclusive); ``extra`` is the way back (see ``folding``). Occurrences of one
    term do not overlap, left to right, whether they respect boundaries or not. Work is one search of the text per term.
    """
    found: dict[tuple[str, int, int], None] = {}
    for term in terms:
        needle, width = term["needle"], len(term["needle"])
        at = folded.find(needle)
        while at >= 0:
            end = at + width
            if term["cjk"] or not (at > 0 and _in_word(folded[at - 1]) or end < len(folded) and _in_word(folded[end])):
                found[term["identity"], at - bisect_right(extra, at), end - bisect_right(extra, end - 1)] = None
            at = folded.find(needle, end)
    return [(identity, start, end, text[start:end]) for identity, start, end in found]


def longest_spans(candidates: Column) -> Column:
    """Greedy choice inside one group of overlapping spans: longest first, then leftmost.

    A span goes when it overlaps a kept one; identical spans of several identities all stay.
    """
    ordered = F.array_sort(F.transform(
        candidates,
        lambda c: F.struct(
            (c["start"] - c["end"]).alias("negative_width"),
            *[c[n].alias(n) for n in ("start", "identity", "end", "matched_text")],
        ),
    ))

    def clashes(kept: Column, c: Column) -> Column:
        return F.exists(
            kept,
            lambda k: (c["start"] < k["end"])
            & (k["start"] < c["end"])
            & ~((c["start"] == k["start"]) & (c["end"] == k["end"])),
        )

    def one(c: Column) -> Column:
        return F.array(F.struct(*[c[n].alias(n) for n in ("identity", "start", "end", "matched_text")]))

    return F.aggregate(
        ordered,
        F.array().cast("array<struct<identity:string,start:int,end:int,matched_text:string>>"),
        lambda kept, c: F.when(clashes(kept, c), kept).otherwise(F.concat(kept, one(c))),
    )

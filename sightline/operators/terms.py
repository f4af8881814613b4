"""Matching registry terms against texts without pairing every text with every term.

For spans, the words of a text meet the terms' anchor words in an equi-join of narrow rows, and only
rows with candidates are joined back to their texts. Plain containment (``attach_substrings``) joins the character runs of a text with
an index that holds every term under its rarest run.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sightline.functions.cols import any_of
from sightline.functions.dates import valid_on
from sightline.functions.folding import fold, folding
from sightline.functions.text import SYMBOL, anchor, is_cjk, longest_spans, spans_of, words
from sightline.operators.shape import computed, growing, union_all
from sightline.session import stored

BLANK_ENDS = r"^[\p{Z}\s\x1c-\x1f\x85]+|[\p{Z}\s\x1c-\x1f\x85]+$"
TERM = ("identity", "needle", "cjk", "anchor", "start_date", "end_date")
SPAN = [
    T.StructField("identity", T.StringType()), T.StructField("span_start", T.IntegerType()),
    T.StructField("span_end", T.IntegerType()), T.StructField("matched_text", T.StringType()),
]
PORTION = 100_000


def stripped(text: str) -> Column:
    """The text without white space (of any script) at its ends."""
    return F.regexp_replace(F.col(text), BLANK_ENDS, "")


def term_table(
    df: DataFrame, identity: str, text: str, start: str | None = None, end: str | None = None
) -> DataFrame:
    """Folded, non-blank terms with their anchor word and validity window."""
    bound = lambda c: (F.to_date(c) if c else F.lit(None)).cast("date")
    needle = fold(stripped(text))
    return (
        df.select(
            F.col(identity).cast("string").alias("identity"),
            needle.alias("needle"),
            bound(start).alias("start_date"),
            bound(end).alias("end_date"),
        )
        .filter(F.length("needle") > 0)
        .withColumn("cjk", is_cjk("needle"))
        .withColumn("anchor", F.coalesce(anchor("needle"), F.substring("needle", 1, 1)))
        .select(*TERM)
        .distinct()
    )


def attach_terms(rows: DataFrame, keys: Sequence[str], folded: str, terms: DataFrame) -> DataFrame:
    """Adds ``_terms``: the terms whose anchor occurs in the folded text (null when there is none).

    The anchors of a text meet those of the terms in an equi-join of narrow rows; terms without any word are anchored by
    their first character, so no anchor is shared by all texts.
    """
    own = F.array_distinct(F.concat(words(folded), F.regexp_extract_all(F.col(folded), F.lit(SYMBOL), F.lit(0))))
    narrow = rows.select(*keys, F.explode(own).alias("anchor"))
    found = narrow.join(terms, "anchor").groupBy(*keys).agg(
        F.collect_list(F.struct(*TERM)).alias("_terms")
    )
    return rows.join(growing(found), list(keys), "left")


def match_spans(
    rows: DataFrame,
    keys: Sequence[str],
    text: str,
    terms: DataFrame,
    as_of: str | None = None,
    suppress: bool = True,
) -> DataFrame:
    """One row per kept span: the input columns (without the text) plus identity, span_start,
    span_end and matched_text.

    Only terms valid on the row's ``as_of`` date take part, also when overlaps are decided.
    ``suppress=False`` keeps overlapping spans of different terms.
    """
    # Dealt out first: a file of a single row group would be folded and searched in one task.
    folded = computed(rows.repartition(*keys), _fold=folding(text))
    folded = computed(folded, _folded=F.col("_fold.folded"), _extra=F.col("_fold.extra"))
    candidates = attach_terms(folded, keys, "_folded", terms).filter(F.size("_terms") > 0)
    usable: Column = F.col("_terms")
    if as_of is not None:
        usable = F.filter(
            usable,
            lambda t: valid_on(t["start_date"], t["end_date"], F.col(as_of))
            | (t["start_date"].isNull() & t["end_date"].isNull()),
        )
    kept = [c for c in rows.columns if c != text]
    wanted = F.transform(usable, lambda t: F.struct(*[t[n].alias(n) for n in ("identity", "needle", "cjk")]))
    found = candidates.select(*kept, F.col(text).alias("_text"), "_folded", "_extra", wanted.alias("_wanted"))
    schema = T.StructType([*[f for f in rows.schema.fields if f.name != text], *SPAN])
    spans = found.mapInArrow(_span_rows(kept), schema)
    return _longest(spans, keys, kept) if suppress else spans


def _span_rows(kept: Sequence[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow function: a row per span of a text's wanted terms, in portions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.select(list(kept))
            rows: list[int] = []
            found: list[tuple] = []
            columns = [batch.column(c) for c in ("_text", "_folded", "_extra", "_wanted")]
            for n, parts in enumerate(zip(*columns)):
                spans = spans_of(*[part.as_py() for part in parts])
                rows.extend([n] * len(spans))
                found.extend(spans)
                if len(found) >= PORTION:
                    yield _batch(own, rows, found)
                    rows, found = [], []
            if found:
                yield _batch(own, rows, found)
    return run


def _batch(own: pa.RecordBatch, rows: list[int], found: list[tuple]) -> pa.RecordBatch:
    copies = own.take(pa.array(rows, pa.int64()))
    types = (pa.string(), pa.int32(), pa.int32(), pa.string())
    spans = [pa.array(values, kind) for values, kind in zip(zip(*found), types)]
    return pa.RecordBatch.from_arrays([*copies.columns, *spans], [*own.schema.names, *[f.name for f in SPAN]])


def _longest(spans: DataFrame, keys: Sequence[str], kept: Sequence[str]) -> DataFrame:
    """Drops spans that overlap a longer one.

    Runs of overlapping spans are cut apart by a running maximum of the span ends; the greedy
    choice then only looks at the few spans of one run, and a lone span needs no choice at all.
    """
    order = Window.partitionBy(*keys).orderBy("span_start", "span_end", "identity")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    runs = spans.withColumn(
        "_new", F.coalesce(F.col("span_start") >= F.max("span_end").over(before), F.lit(True)).cast("int")
    ).withColumn("_run", F.sum("_new").over(upto))
    others = [c for c in kept if c not in keys]
    span = F.struct("identity", F.col("span_start").alias("start"), F.col("span_end").alias("end"), "matched_text")
    grouped = runs.groupBy(*keys, "_run").agg(
        *[F.first(c).alias(c) for c in others], F.collect_list(span).alias("_spans")
    )
    chosen = F.when(F.size("_spans") == 1, F.col("_spans")).otherwise(longest_spans(F.col("_spans")))
    return grouped.select(*kept, F.inline(chosen)).select(
        *kept, "identity", F.col("start").alias("span_start"), F.col("end").alias("span_end"), "matched_text"
    )


GRAM = 3


def _grams(text: Column, sizes: Column) -> Column:
    """Distinct character runs of the given lengths, by look-ahead so that they overlap."""
    none = F.array().cast("array<string>")
    runs = [
        F.when(F.array_contains(sizes, n), F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))).otherwise(none)
        for n in range(1, GRAM + 1)
    ]
    return F.array_distinct(F.concat(*runs))


def _tagged(kind: str) -> Column:
    return F.transform(F.col(kind), lambda gram: F.struct(F.lit(kind).alias("kind"), gram.alias("gram")))


def _held(kind: str, texts: Sequence[str]) -> Callable[[Column], Column]:
    return lambda term: (term["kind"] == kind) & any_of(*[F.coalesce(F.col(t).contains(term["needle"]), F.lit(False)) for t in texts])


def attach_substrings(rows: DataFrame, key: str, wanted: Mapping[str, tuple[Sequence[str], DataFrame]]) -> DataFrame:
    """Adds an array per entry of ``wanted``: identities of its term rows contained in at least one of its texts.

    Plain containment without word boundaries; terms have identity and needle columns, both sides already lower case and needles not
    blank. An identity appears once per containing term row. Texts with a run of a term's characters are found by a
    rarest-gram index: a term is kept under that of its character runs of length GRAM (or its own length, if shorter) which the fewest
    texts hold, so a text meets few terms, and only those are looked for in it. Only run lengths that some term has are cut.
    Rows partitioned by the key stay where they are.
    """
    listed = union_all([df.select(F.lit(out).alias("kind"), "identity", "needle") for out, (_, df) in wanted.items()])
    terms = listed.withColumn("_size", F.least(F.lit(GRAM), F.length("needle")))
    runs = F.transform(F.sequence(F.lit(1), F.length("needle") - F.col("_size") + 1), lambda i: F.substring(F.col("needle"), i, F.col("_size")))
    grams = terms.select("kind", "needle", F.explode(F.array_distinct(runs)).alias("gram")).distinct()
    cut = {}
    for out, (texts, _) in wanted.items():
        sizes = terms.filter(F.col("kind") == out).agg(F.collect_set("_size")).scalar()
        cut[out] = _grams(F.concat_ws("\n", *[F.col(t) for t in texts]), sizes)
    tagged = [_tagged(out) for out in cut]
    runs_of_text = computed(rows, **cut).select(key, F.inline(F.concat(*tagged)))
    narrow = stored(runs_of_text.join(grams.select("kind", "gram").distinct(), ["kind", "gram"]), "grams")
    holding = narrow.groupBy("kind", "gram").agg(F.count("*").alias("_texts"))
    # A run that no text holds settles that the term is in none.
    fewest = F.min(F.struct(F.coalesce("_texts", F.lit(0)).alias("n"), "gram"))
    rarest = grams.join(holding, ["kind", "gram"], "left").groupBy("kind", "needle").agg(fewest.alias("r"))
    index = terms.join(rarest, ["kind", "needle"]).select("kind", "identity", "needle", F.col("r.gram").alias("gram"))
    pairs = growing(narrow).join(index, ["kind", "gram"]).groupBy(key).agg(F.collect_list(F.struct("kind", "identity", "needle")).alias("_terms"))
    joined = rows.join(growing(pairs), key, "left")
    none = F.array().cast("array<struct<kind:string,identity:string,needle:string>>")
    for out, (texts, _) in wanted.items():
        joined = joined.withColumn(out, F.transform(F.filter(F.coalesce("_terms", none), _held(out, texts)), lambda t: t["identity"]))
    return joined.drop("_terms")

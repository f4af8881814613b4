"""Evidence trees: every item of a provider result and its nested children as rows.

The first ``CHAIN`` levels are unrolled by narrow ``explode`` steps: each replaces a row of the current
depth by itself plus its children and passes all other rows through. What hangs below a node of depth
``CHAIN`` is unrolled inside its row, level by level, while the last one has nodes. So the payload is
scanned once, nothing is shuffled or stored and no level is computed twice. ``ROUNDS`` times ``STRIDE``
levels are more than JSON that parses can nest, and a deeper tree raises. ``Grammar`` says which child
keys are evidence of which kind.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions import jsonx
from sightline.functions.cols import any_of, case, let
from sightline.functions.ids import evidence_id, text_part
from sightline.functions.text import inline_links, label_text, visible_text
from sightline.functions.url import canonical_url, hostname
from sightline.schemas import FEATURE_EVIDENCE_VERSION, RESPONSE_EVIDENCE_VERSION

NODE = (
    "struct<path:string,parent_path:string,parent_kind:string,kind:string,top:boolean,depth:int,"
    "value:variant>"
)
NODES = f"array<{NODE}>"
# Rounds without nodes are passed over; 1,024 levels below the chain, the parser of JSON stops at 1,000.
CHAIN, STRIDE, ROUNDS = 3, 16, 64

# Nested content that is provider metadata, not evidence.
IGNORED_KEYS = (
    "price", "rating", "rectangle", "checks", "highlighted", "table", "id_to_token_map",
    "product_ids",
)
ALWAYS_CHILDREN = {"images": "image", "sources": "citation", "references": "citation"}


@dataclass(frozen=True)
class Grammar:
    """Kinds by raw type, and child kinds by (parent kind, key)."""

    version: str
    top_serp: dict[str, str]
    top_answer: dict[str, str]
    children: dict[tuple[str, str], str]
    answer_kind: str
    retain_nested: bool
    strict_kinds: tuple[str, ...] = ()
    any_child: dict[str, str] = field(default_factory=lambda: dict(ALWAYS_CHILDREN))


# The two generations of the evidence grammar.
FEATURE_GRAMMAR = Grammar(
    version=FEATURE_EVIDENCE_VERSION,
    top_serp={
        "organic": "organic", "paid": "paid", "shopping": "product_module",
        "related_searches": "related_module", "images": "serp_module",
        "featured_snippet": "serp_module", "ai_overview": "answer_module",
    },
    top_answer={
        "chat_gpt_text": "answer_text", "chat_gpt_table": "answer_text",
        "chat_gpt_products": "product_module", "gemini_text": "answer_text",
        "gemini_table": "answer_text", "gemini_products": "product_module",
    },
    children={
        ("product_module", "items"): "product", ("related_module", "items"): "related_search",
        ("paid", "links"): "ad_link", ("answer_module", "items"): "answer_text",
    },
    answer_kind="answer_text",
    retain_nested=True,
    strict_kinds=("organic", "paid", "product", "answer_text", "ad_link"),
)
RESPONSE_GRAMMAR = Grammar(
    version=RESPONSE_EVIDENCE_VERSION,
    top_serp={
        "organic": "organic", "shopping": "product_module", "related_searches": "related_module",
        "images": "serp_item", "featured_snippet": "serp_item",
    },
    top_answer={
        "chat_gpt_text": "answer_block", "chat_gpt_table": "answer_block",
        "chat_gpt_products": "product_module", "gemini_text": "answer_block",
        "gemini_table": "answer_block", "gemini_products": "product_module",
    },
    children={
        ("product_module", "items"): "product_card", ("related_module", "items"): "related_search",
    },
    answer_kind="answer_block",
    retain_nested=False,
)


def top_kind(grammar: Grammar, category: Column, raw_type: Column) -> Column:
    serp = case([(raw_type == t, k) for t, k in grammar.top_serp.items()], "unsupported")
    answer = case([(raw_type == t, k) for t, k in grammar.top_answer.items()], "unsupported")
    return F.when(category == "llm", answer).otherwise(serp)


def child_kind(grammar: Grammar, kind: Column, raw_type: Column, key: Column) -> Column:
    """Kind of the children under a key; null when the key holds no known children."""
    branches = [((kind == "answer_module") & (key == "items"), grammar.children.get(("answer_module", "items")))]
    branches.append((F.coalesce(raw_type == "images", F.lit(False)) & (key == "items"), "image"))
    branches += [((kind == k) & (key == name), child) for (k, name), child in grammar.children.items()]
    branches += [(key == name, child) for name, child in grammar.any_child.items()]
    return case([(c, v) for c, v in branches if v is not None])


def child_keys(grammar: Grammar) -> list[str]:
    """Keys under which some node has known children."""
    return sorted({key for _, key in grammar.children} | {"items"} | set(grammar.any_child))


def nested_content(kind: Column, key: Column, value: Column) -> Column:
    """A non-empty object or list under a key that is neither known children nor metadata."""
    obj, rows = jsonx.members(value), jsonx.elements(value)
    filled = (F.coalesce(F.size(obj), F.lit(0)) > 0) | (F.coalesce(F.size(rows), F.lit(0)) > 0)
    ad_metadata = (kind == "paid") & (key == "extra") & obj.isNotNull() & F.forall(
        F.map_keys(obj), lambda k: k == "ad_aclk"
    )
    return ~key.isin(*IGNORED_KEYS) & filled & ~F.coalesce(ad_metadata, F.lit(False))


def node(
    path: Column, kind: Column | str, value: Column, *, top: bool = False, depth: Column | int = 0,
    parent: Column | None = None, parent_kind: Column | None = None,
) -> Column:
    """A tree node as a struct; root nodes have no parent."""
    none = F.lit(None).cast("string")
    return F.struct(
        path.alias("path"), (none if parent is None else parent).alias("parent_path"),
        (none if parent_kind is None else parent_kind).alias("parent_kind"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        F.lit(top).alias("top"), (depth if isinstance(depth, Column) else F.lit(depth)).alias("depth"),
        value.alias("value"),
    )


def _settled(grammar: Grammar, kind: Column, value: Column) -> Column:
    """Kind after the check that evidence nodes are objects."""
    if grammar.retain_nested:
        wrong = kind.isin(*grammar.strict_kinds)
    else:
        wrong = ~kind.isin("image", "related_search")
    return F.when(wrong & ~jsonx.is_object(value), F.lit("unsupported")).otherwise(kind)


def answer_source(value: Column) -> Column:
    """Name of the text representation used: the first non-empty of the three."""
    return case([
        (jsonx.nonempty(value, f"$.{k}").isNotNull(), k) for k in ("original_text", "markdown", "text")
    ])


def answer_raw_text(value: Column, with_table: bool = True) -> Column:
    texts = [jsonx.nonempty(value, f"$.{k}") for k in ("original_text", "markdown", "text")]
    if with_table:
        texts.append(jsonx.table_text(value, "$.table"))
    return F.coalesce(*texts)


def _children(grammar: Grammar, own: Column) -> Column:
    """Child nodes of a node."""
    kind, value, path, below = own["kind"], own["value"], own["path"], own["depth"] + 1
    empty = F.array().cast(NODES)

    def of_kind(entry: Column) -> Column:
        key, inner, as_kind = entry["key"], entry["value"], entry["kind"]
        at = F.concat(path, F.lit("."), key)
        rows = F.transform(
            jsonx.as_list(inner),
            lambda child, i: node(
                F.concat(at, F.lit("["), i.cast("string"), F.lit("]")),
                _settled(grammar, as_kind, child), child, depth=below, parent=path,
                parent_kind=kind,
            ),
        )
        found = F.when(as_kind.isNotNull(), F.coalesce(rows, empty))
        if grammar.retain_nested:
            found = found.when(
                nested_content(kind, key, inner),
                F.array(node(at, "retained_nested", inner, depth=below, parent=path, parent_kind=kind)),
            )
        return found.otherwise(empty)

    # Kinds are settled in entries of their own: what a function over entries gives is copied by every function around it.
    raw_type = jsonx.text(value, "$.type")
    known = F.transform(jsonx.nested_entries(value), lambda e: F.struct(
        e["key"].alias("key"), e["value"].alias("value"), child_kind(grammar, kind, raw_type, e["key"]).alias("kind")))
    listed = F.when(jsonx.has_nested(value), F.flatten(F.transform(known, of_kind))).otherwise(empty)

    def links(text: Column) -> Column:
        rows = let(F.coalesce(answer_source(value), F.lit("table")), lambda source: F.transform(
            inline_links(text),
            lambda link: node(
                F.concat(path, F.lit("."), source, F.lit(".inline_links["), link["index"].cast("string"), F.lit("]")),
                "citation",
                F.parse_json(F.to_json(F.struct(link["url"].alias("url"), F.lit("inline_link").alias("type")))),
                depth=below, parent=path, parent_kind=kind,
            ),
        ))
        return F.when(text.contains("]("), F.coalesce(rows, empty)).otherwise(empty)

    text = answer_raw_text(value, with_table=grammar.retain_nested)
    return F.when(kind == grammar.answer_kind, F.concat(listed, let(text, links))).otherwise(listed)


def roots(grammar: Grammar) -> Column:
    """Top-level item nodes and result-level source nodes of a row's ``result``."""
    base = F.col("json_path")
    items = F.transform(
        jsonx.as_list("result", "$.items"),
        lambda raw, i: node(
            F.concat(base, F.lit(".items["), i.cast("string"), F.lit("]")),
            _settled(grammar, top_kind(grammar, F.col("source_category"), jsonx.text(raw, "$.type")), raw),
            raw, top=True,
        ),
    )
    sources = F.transform(
        jsonx.as_list("result", "$.sources"),
        lambda raw, i: node(
            F.concat(base, F.lit(".sources["), i.cast("string"), F.lit("]")),
            _settled(grammar, F.lit("citation"), raw), raw,
        ),
    )
    empty = F.array().cast(f"array<{NODE}>")
    return F.concat(F.coalesce(items, empty), F.coalesce(sources, empty))


def walk(results: DataFrame, grammar: Grammar) -> DataFrame:
    """All evidence nodes of the results, at any depth.

    Input: observation_id, result_id, source_category, json_path and ``result`` (VARIANT).
    Output: item_id, parent_item_id, json_path, item_kind, is_top_level, depth and ``value``;
    ``unexpanded`` is false for every node of a whole walk.
    """
    return expand(results, roots(grammar), grammar)


def expand(results: DataFrame, start: Column, grammar: Grammar) -> DataFrame:
    """The walk from given start nodes (an array column expression over ``results``)."""
    keys = ["observation_id", "result_id", "source_category", *[c for c in ("collected_at",) if c in results.columns]]
    own = F.array(F.col("node"))
    rows = results.select(*keys, F.explode(start).alias("node"))
    for depth in range(CHAIN):
        grown = F.when(F.col("node.depth") == depth, F.concat(own, _children(grammar, F.col("node")))).otherwise(own)
        rows = rows.select(*keys, F.explode(grown).alias("node"))

    def level(found: Column, depth: Column) -> Column:
        last = F.filter(found, lambda n: n["depth"] == depth)
        return F.when(F.size(last) > 0, F.concat(found, F.flatten(F.transform(last, lambda n: _children(grammar, n))))).otherwise(found)

    def several(found: Column, top: Column) -> Column:
        whole = F.aggregate(F.sequence(top, top + STRIDE - 1), found, level)
        return F.when(F.exists(found, lambda n: n["depth"] == top), whole).otherwise(found)

    limit = CHAIN + STRIDE * ROUNDS
    deeper = F.raise_error(F.lit(f"evidence below {limit} levels")).cast(NODES)
    rest = F.aggregate(
        F.sequence(F.lit(CHAIN), F.lit(limit - STRIDE), F.lit(STRIDE)), own.cast(NODES), several,
        lambda found: F.when(F.exists(found, lambda n: n["depth"] == limit), deeper).otherwise(found),
    )
    rows = rows.select(*keys, F.explode(F.when(F.col("node.depth") == CHAIN, rest).otherwise(own)).alias("node")).withColumn("unexpanded", F.lit(False))
    return rows.select(*keys, "node.*", "unexpanded").select(
        *keys,
        item_id("path", grammar.version).alias("item_id"),
        F.when(F.col("parent_path").isNotNull(), item_id("parent_path", grammar.version)).alias("parent_item_id"),
        F.col("path").alias("json_path"), F.col("kind").alias("item_kind"), "parent_kind",
        F.col("top").alias("is_top_level"), "depth", "value", "unexpanded",
    )


def item_id(path: str, version: str) -> Column:
    return evidence_id(text_part("observation_id"), text_part(path), version)


def unexpanded_nodes(nodes: DataFrame) -> DataFrame:
    """Nodes whose children were not reached; an empty frame means the walk is whole."""
    return nodes.filter("unexpanded").select("observation_id", "item_id", "json_path")


def feature_items(nodes: DataFrame) -> DataFrame:
    """Typed item rows of the feature grammar; values of the wrong type become null."""
    v, kind = "value", F.col("item_kind")
    # Plain columns: what a query does not use is not read out of the payloads.
    dates = [c for c in ("collected_at",) if c in nodes.columns]
    nodes = nodes.withColumns({
        "_url": jsonx.text(v, "$.url"), "_rank": jsonx.integer(v, "$.rank_group"), "_type": jsonx.text(v, "$.type"),
        "_text": F.when(kind == "answer_text", answer_raw_text(F.col(v))),
    })
    url, rank, text = F.col("_url"), F.col("_rank"), F.col("_text")
    known = any_of(kind == "unsupported", (kind == "answer_text") & text.isNull(),
                   (kind == "citation") & canonical_url("_url").isNull(), has_nested(F.col(v), kind, raw_type=F.col("_type")))
    return nodes.select(
        "item_id", "observation_id", "result_id", "parent_item_id", "json_path", "is_top_level",
        "item_kind", "source_category", *dates,
        F.try_variant_get(v, "$.type", "string").alias("raw_item_type"),
        jsonx.text(v, "$.title").alias("title"), jsonx.text(v, "$.description").alias("description"),
        url.alias("url"),
        F.coalesce(jsonx.nonempty(v, "$.domain"), hostname("_url"), jsonx.text(v, "$.domain")).alias("domain"),
        rank.alias("rank_group"), jsonx.integer(v, "$.rank_absolute").alias("rank_absolute"),
        F.when(kind == "organic", rank).alias("organic_rank"),
        jsonx.integer(v, "$.rank_absolute").alias("page_position"),
        visible_text(text).alias("normalized_text"),
        F.when(text.isNotNull(), F.coalesce(answer_source(F.col(v)), F.lit("scalar_table_cells"))).alias("text_method"),
        F.when(F.coalesce(known, F.lit(False)), "partial").otherwise("complete").alias("coverage_status"),
        jsonx.canonical(v).alias("raw_evidence_json"), "value",
        F.lit(FEATURE_EVIDENCE_VERSION).alias("enrichment_version"),
    )


def has_nested(value: Column, kind: Column, grammar: Grammar = FEATURE_GRAMMAR, raw_type: Column | None = None) -> Column:
    """The node holds nested content nobody understands."""
    own = jsonx.text(value, "$.type") if raw_type is None else raw_type
    return jsonx.has_nested(value) & F.exists(
        jsonx.nested_entries(value),
        lambda e: nested_content(kind, e["key"], e["value"]) & child_kind(grammar, kind, own, e["key"]).isNull(),
    )


def response_fields(value: Column, kind: Column) -> dict[str, Column]:
    """Matchable text fields of a first-generation node."""
    serp = kind.isin("organic", "serp_item")
    card = kind == "product_card"
    source = answer_source(value)
    answer = label_text(answer_raw_text(value, with_table=False))
    fields = {
        f: F.when(serp | card, jsonx.text(value, f"$.{f}")) for f in ("title", "description")
    }
    fields["brand"] = F.when(card, jsonx.text(value, "$.brand"))
    for name in ("original_text", "markdown", "text"):
        fields[name] = F.when((kind == "answer_block") & (source == name), answer)
    return fields

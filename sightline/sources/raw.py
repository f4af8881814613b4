"""Raw evidence files: inventory, integrity of request/response/metadata triples, registration.

A raw frame has the columns of Spark's ``binaryFile`` source (path, length, content). Paths end in
``category/provider/engine/YYYY/MM/DD/run/request/file.json``.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from sightline.functions import jsonx
from sightline.functions.cols import ColumnLike, case, col
from sightline.operators.shape import computed, first_per, growing, two_way_difference, union_all

CATEGORIES = ("serp", "llm")
ROLES = {"metadata.json": "metadata", "request.json": "request", "response.json": "response"}
MANIFEST_ROLES = ("request", "response")
REQUIRED_METADATA = ("request_id", "run_id", "provider", "platform_or_engine", "collected_at")
# Fixed value: how the folders below the raw root are named.
PATH_PATTERN = r"(?:^|/)((serp|llm)/([^/]+)/([^/]+)/(\d{4})/(\d{2})/(\d{2})/([^/]+)/([^/]+))/([^/]+\.json)$"


def read_raw(spark: SparkSession, root: str, day: str | None = None) -> DataFrame:
    """JSON files below a raw root; a ``YYYY-MM-DD`` day becomes a folder glob, so other days are
    not even listed."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
    if day is None:
        return reader.option("recursiveFileLookup", "true").load([f"{root}/{c}" for c in CATEGORIES])
    y, m, d = day.split("-")
    categories = "{" + ",".join(CATEGORIES) + "}"
    return reader.load(f"{root}/{categories}/*/*/{y}/{m}/{d}/*/*")


def with_path_parts(files: DataFrame) -> DataFrame:
    """Files with the parts of their path; the pattern is matched once per file. Parts of other paths are null."""
    rows = computed(files, raw_path=F.ltrim(F.regexp_extract("path", PATH_PATTERN, 0), F.lit("/")))
    part = lambda n: F.nullif(F.split_part("raw_path", F.lit("/"), F.lit(n)), F.lit(""))
    return (
        rows.withColumn("directory", F.nullif(F.substring_index("raw_path", "/", 8), F.lit(""))).withColumn("category", part(1))
        .withColumn("path_provider", part(2)).withColumn("path_engine", part(3))
        .withColumn("folder_date", F.try_to_date(F.concat_ws("-", part(4), part(5), part(6))))
        .withColumn("file_name", part(9))
    )


def on_day(files: DataFrame, day: str) -> DataFrame:
    """Files of one folder date (not the payload time)."""
    return files.filter(F.col("folder_date") == F.lit(day).cast("date"))


def json_kind(text: ColumnLike) -> Column:
    """Kind of a valid JSON text, by its first character."""
    first = F.substring(F.ltrim(text, F.lit(" \t\r\n")), 1, 1)
    return case([
        (first == "{", "object"), (first == "[", "array"), (first == '"', "string"), (first.isin("t", "f"), "boolean"), (first == "n", "null"),
    ], "number")


def inventory(files: DataFrame) -> DataFrame:
    """One row per JSON file: role, size, checksum, validity and parsed ``document``."""
    parts = with_path_parts(files).filter("raw_path <> ''")
    # Bytes that are not UTF-8 are not JSON either.
    text = F.try_validate_utf8(F.col("content").cast("string"))
    role = case([(F.col("file_name") == name, r) for name, r in ROLES.items()], "auxiliary")
    rows = computed(parts, document=jsonx.parse(text))
    return rows.select(
        F.col("raw_path").alias("path"), "directory", "category", "path_provider",
        "path_engine", "folder_date", role.alias("role"), F.col("length").alias("byte_size"),
        F.sha2("content", 256).alias("sha256"),
        F.col("document").isNotNull().alias("json_valid"), F.when(F.col("document").isNotNull(), json_kind(text)).alias("json_type"),
        "document",
    )


def _digest(text: ColumnLike) -> Column:
    """A checksum's 64 hexadecimal digits as 32 bytes; other texts as more than 32 bytes, so that equal bytes are equal texts."""
    whole = F.concat(F.encode(text, "UTF-8"), F.unhex(F.lit("00" * 33)))
    return F.when(col(text).rlike("^[0-9a-f]{64}\\z"), F.unhex(text)).otherwise(whole)


def _digits(digest: ColumnLike) -> Column:
    """The text of a digest."""
    size = F.octet_length(digest)
    return F.when(size == 32, F.lower(F.hex(digest))).otherwise(F.decode(F.substring(digest, F.lit(1), size - 33), "UTF-8"))


def _metadata_type() -> str:
    entry = "struct<sha256:string,byte_size:string,content_type:variant>"
    files = ",".join(f"`{role}.json`:{entry}" for role in MANIFEST_ROLES)
    return "struct<" + ",".join(f"{key}:variant" for key in (*REQUIRED_METADATA, "source_category")) + f",files:struct<{files}>>"


def _text(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def metadata_facts(metadata: ColumnLike) -> Column:
    """What the verdict on a triple needs of its metadata (the fields of ``_metadata_type``): identity, manifest entries, problems of its own."""
    m = col(metadata)

    def entry(role: str) -> Column:
        e = m["files"][f"{role}.json"]
        return F.struct(
            e.isNotNull().alias("listed"), _digest(e["sha256"]).alias("sha256"), e["byte_size"].try_cast("bigint").alias("byte_size"),
            _text(e["content_type"]).isNotNull().alias("typed"),
        ).alias(role)

    stamp = _text(m["collected_at"])
    stamped = case([
        (stamp.try_cast("timestamp").isNull(), "invalid collected_at"),
        (~stamp.rlike(r"(?:Z|[+-]\d{2}:?\d{2})$"), "collected_at is not timezone aware"),
    ])
    empty = [F.when(F.nullif(_text(m[key]), F.lit("")).isNull(), F.lit(f"missing metadata {key}")) for key in REQUIRED_METADATA]
    return F.struct(
        _text(m["request_id"]).alias("request_id"), _text(m["platform_or_engine"]).alias("engine_or_platform"),
        stamp.alias("collected_at"), _text(m["source_category"]).alias("source_category"),
        F.array_compact(F.array(F.when(m["files"].isNull(), F.lit("metadata has no file manifest")), *empty, stamped)).alias("problems"),
        *[entry(role) for role in MANIFEST_ROLES],
    )


#: Problems of a triple whose metadata is missing or no object.
WITHOUT_METADATA = ("metadata has no file manifest", *(f"missing metadata {key}" for key in REQUIRED_METADATA), "invalid collected_at")


def _narrow(files: DataFrame) -> DataFrame:
    """Files by what triples are judged by: no document leaves its task."""
    canonical = F.when(
        F.col("json_valid") & F.col("role").isin("response", "auxiliary"), F.unhex(F.sha2(jsonx.canonical("document"), 256))
    )
    known = (F.col("role") == "metadata") & (F.col("json_type") == "object")
    kept = ("path", "directory", "category", "role", "byte_size", "sha256", "json_valid", "json_type")
    rows = computed(
        files.select(*kept, "document"), _canonical=canonical,
        _metadata=F.when(known, F.try_variant_get("document", "$", _metadata_type())),
    )
    return rows.withColumn("sha256", _digest("sha256")).select(*kept, "_canonical", F.when(F.col("_metadata").isNotNull(), metadata_facts("_metadata")).alias("_facts"))


def _sides() -> dict[str, Column]:
    """Aggregates over the files of a directory: one struct per role, the facts of the metadata and the response's canonical checksum."""
    sides = {
        role: F.max(F.when(F.col("role") == role, F.struct("sha256", "byte_size", "json_valid", "json_type")))
        for role in ("metadata", "request", "response")
    }
    return {f"_{k}": v for k, v in sides.items()} | {
        "_of": F.max("_facts"), "_same": F.max(F.when(F.col("role") == "response", F.col("_canonical"))),
    }


def triples(files: DataFrame) -> DataFrame:
    """One row per directory with its request, response and metadata files side by side."""
    return _narrow(files).groupBy("directory", "category").agg(*[v.alias(k) for k, v in _sides().items()])


def integrity_problems() -> Column:
    """Sorted problem names of one triple row; an empty array means the triple is sound."""
    checks: list[Column] = []
    for role in ("metadata", "request", "response"):
        side = F.col(f"_{role}")
        checks.append(case([
            (side.isNull(), f"missing {role}.json"),
            (~side["json_valid"], f"invalid JSON {role}.json"),
            (side["json_type"] != "object", f"non-object {role}.json"),
        ]))
    facts = F.col("_of")
    for role in MANIFEST_ROLES:
        side, entry = F.col(f"_{role}"), facts[role]
        listed = F.coalesce(entry["listed"], F.lit(False))
        present = side.isNotNull()
        checks += [
            F.when(~listed, F.lit(f"missing file manifest {role}.json")),
            F.when(listed & present & ~side["sha256"].eqNullSafe(entry["sha256"]), F.lit(f"checksum mismatch for {role}.json")),
            F.when(listed & present & ~side["byte_size"].eqNullSafe(entry["byte_size"]), F.lit(f"size mismatch for {role}.json")),
            F.when(listed & present & ~entry["typed"], F.lit(f"missing content_type for {role}.json")),
        ]
    checks.append(F.when(~facts["source_category"].eqNullSafe(F.col("category")), F.lit("source_category/path mismatch")))
    alone = F.coalesce(facts["problems"], F.array(*map(F.lit, WITHOUT_METADATA)))
    return F.array_sort(F.concat(F.array_compact(F.array(*checks)), alone))


def triple_integrity(files: DataFrame) -> DataFrame:
    rows = computed(triples(files), integrity_problems=integrity_problems())
    return rows.select(
        "directory", "category", F.col("_of.request_id").alias("request_id"), F.col("_of.engine_or_platform").alias("engine_or_platform"),
        F.col("_of.collected_at").alias("collected_at"), "integrity_problems", (F.size("integrity_problems") == 0).alias("triple_valid"),
    )


def dispositions(files: DataFrame) -> DataFrame:
    """Every file with its triple's verdict and what becomes of it.

    The narrow files are shuffled once, by directory; what their triple is judged by comes beside them.
    """
    around = Window.partitionBy("directory", "category")
    rows = _narrow(files).withColumns({k: v.over(around) for k, v in _sides().items()})
    rows = computed(rows, integrity_problems=integrity_problems())
    valid = F.size("integrity_problems") == 0
    auxiliary = F.col("role") == "auxiliary"
    disposition = case([
        (auxiliary & ~F.col("json_valid"), "quarantined_auxiliary"),
        (auxiliary & F.coalesce(F.col("_canonical") == F.col("_same"), F.lit(False)), "duplicate_response_representation"),
        (auxiliary, "auxiliary_not_result"),
        (~valid, "quarantined_integrity"),
        (F.col("role") != "response", F.concat("role", F.lit("_evidence_not_result"))),
    ], "verified_response_candidate")
    return rows.select(
        "path", "directory", "category", "role", "byte_size", _digits("sha256").alias("sha256"), "json_valid", "json_type",
        F.col("_of.request_id").alias("request_id"), F.col("_of.engine_or_platform").alias("engine_or_platform"),
        F.col("_of.collected_at").alias("collected_at"), valid.alias("triple_valid"), "integrity_problems",
        disposition.alias("disposition"),
    )


def verify_manifest(files: DataFrame) -> DataFrame:
    """Manifests against the files of their directory: one row per file and problem, or `verified`.

    The request and the response are expected even if the manifest does not name them. Metadata without a
    manifest give one row `missing_manifest` without a file name.
    """
    listed = files.filter("role = 'metadata' and json_type = 'object'").select(
        "directory", jsonx.as_object("document", "$.files").alias("listed")
    )
    names = F.array_union(F.map_keys("listed"), F.array(F.lit("request.json"), F.lit("response.json")))
    entries = listed.select("directory", "listed", F.explode_outer(names).alias("file_name")).select(
        "directory", "file_name",
        F.try_variant_get(F.try_element_at("listed", F.col("file_name")), "$.sha256", "string").alias("expected_sha256"),
        F.try_variant_get(F.try_element_at("listed", F.col("file_name")), "$.byte_size", "bigint").alias("expected_size"),
        F.try_variant_get(F.try_element_at("listed", F.col("file_name")), "$", "map<string,variant>").isNotNull().alias("described"),
    )
    actual = files.select(
        "directory", F.element_at(F.split("path", "/"), -1).alias("file_name"), "sha256", "byte_size"
    )
    # Every file has a row here: merged, never sent through the driver.
    rows = entries.join(growing(actual), ["directory", "file_name"], "left")
    found = F.array_compact(F.array(
        F.when(~F.col("byte_size").eqNullSafe(F.col("expected_size")), F.lit("size_mismatch")),
        F.when(~F.col("sha256").eqNullSafe(F.col("expected_sha256")), F.lit("checksum_mismatch")),
    ))
    result = (
        F.when(F.col("file_name").isNull(), F.array(F.lit("missing_manifest")))
        .when(F.col("sha256").isNull() | ~F.col("described"), F.array(F.lit("missing_file")))
        .when(F.size(found) == 0, F.array(F.lit("verified")))
        .otherwise(found)
    )
    return rows.select("directory", "file_name", F.explode(result).alias("result"))


def incomplete_directories(files: DataFrame) -> DataFrame:
    """Directories lacking at least one of the three evidence files."""
    has = {r: F.bool_or(F.col("role") == r) for r in ("metadata", "request", "response")}
    grouped = files.groupBy("directory").agg(*[v.alias(f"has_{k}") for k, v in has.items()])
    return grouped.filter(~(F.col("has_metadata") & F.col("has_request") & F.col("has_response")))


def reconcile_metadata(registered: DataFrame, files: DataFrame) -> DataFrame:
    """Registered paths without a file and files without a registration."""
    return two_way_difference(
        registered.select(F.col("relative_path").alias("path")), files.select("path"), ["path"],
        "registered_file_missing", "file_not_registered",
    )


def new_requests(verdicts: DataFrame, known: DataFrame) -> DataFrame:
    """Verified directories to register; requests that are known already are skipped and unsound
    triples listed as invalid."""
    sound = verdicts.filter("triple_valid")
    one = first_per(sound, ["request_id"], [F.asc("directory")])
    fresh = one.join(known.select("request_id").distinct(), "request_id", "left_anti")
    invalid = verdicts.filter("not triple_valid")
    return union_all([
        fresh.select("directory", "request_id", F.lit("register").alias("action")),
        invalid.select("directory", "request_id", F.lit("invalid").alias("action")),
    ])


def transform_candidates(
    raw_files: DataFrame, requests: DataFrame, responses: DataFrame, done: DataFrame, category: str
) -> DataFrame:
    """Response artifacts of a category whose response has no parsed row yet."""
    artifacts = raw_files.filter("artifact_type = 'response'").select("request_id", "relative_path", "sha256")
    wanted = requests.filter(F.col("source_category") == category).select("request_id", "provider", "query_id")
    ids = responses.select("request_id", "response_id")
    return (
        artifacts.join(wanted, "request_id").join(ids, "request_id")
        .join(done.select("response_id").distinct(), "response_id", "left_anti")
    )


def duplicate_requests(verified: DataFrame) -> DataFrame:
    """Request ids seen more than once: equal response checksum is a duplicate, else a conflict.

    The first file by path is the accepted one. Compared by a join with one narrow row per
    request, so that no group is gathered.
    """
    first = verified.groupBy("request_id").agg(
        F.min(F.struct("path", "sha256")).alias("_first"), F.count("*").alias("_n")
    )
    rows = verified.join(first.filter("_n > 1"), "request_id")
    verdict = case([
        (F.col("path") == F.col("_first.path"), "accepted"),
        (F.col("sha256") == F.col("_first.sha256"), "already_transformed"),
    ], "request_id_collision")
    return rows.select("request_id", "path", verdict.alias("verdict"))


PROVENANCE_FIELDS = (
    "query_id", "search_target_id", "collection_window", "model_name", "request_hash",
    "deduplication_key",
)


def reconcile_context(
    responses: DataFrame, provenance: DataFrame, fields: Sequence[str] = PROVENANCE_FIELDS
) -> DataFrame:
    """Context of verified responses from older stores, matched on request id and checksum.

    A field is used only when all sources (and the response's own metadata) give one value;
    otherwise its name is listed in ``conflicts``.
    """
    keys = ["request_id", "sha256"]
    known = provenance.select(*keys, "source", *fields)
    both = union_all([
        known,
        responses.select(*keys, F.lit(None).cast("string").alias("source"), *[
            (F.col(f) if f in responses.columns else F.lit(None).cast("string")).alias(f) for f in fields
        ]),
    ])
    value = lambda f: F.nullif(F.col(f).cast("string"), F.lit(""))
    # Two extremes decide "exactly one distinct value" without collecting a set.
    grouped = both.groupBy(*keys).agg(
        *[F.min(value(f)).alias(f"_min_{f}") for f in fields],
        *[F.max(value(f)).alias(f"_max_{f}") for f in fields],
        F.count_distinct("source").alias("sources"),
    )
    agreed = [F.when(F.col(f"_min_{f}") == F.col(f"_max_{f}"), F.col(f"_min_{f}")).alias(f) for f in fields]
    clash = F.array_compact(F.array(*[F.when(F.col(f"_min_{f}") != F.col(f"_max_{f}"), F.lit(f)) for f in fields]))
    resolved = grouped.select(*keys, *agreed, clash.alias("conflicts"), "sources")
    return responses.select(*keys).distinct().join(resolved, keys)


CANDIDATE = "verified_response_candidate"


def with_provenance(files: DataFrame, provenance: DataFrame) -> DataFrame:
    """Files with ``exact_provenance``: an older store knows the response by request id and checksum (null for other files).

    Only verified responses are looked up; other files are not shuffled for it.
    """
    known = provenance.select("request_id", "sha256").distinct().withColumn("_known", F.lit(True))
    verified = F.coalesce(F.col("disposition") == CANDIDATE, F.lit(False))
    found = files.filter(verified).join(known, ["request_id", "sha256"], "left")
    return files.filter(~verified).withColumn("exact_provenance", F.lit(None).cast("boolean")).unionByName(
        found.withColumn("exact_provenance", F.coalesce("_known", F.lit(False))).drop("_known")
    )


def write_accounted(files: DataFrame, path: str, statuses: Sequence[str]) -> tuple[DataFrame, dict[str, int]]:
    """Write the manifest (with ``disposition``, ``status`` and ``exact_provenance``) once and count its rows while they are written.

    The counters are those of the tasks whose output was committed: files, files without a disposition, responses,
    responses with each status, and responses an older store knows exactly. Statuses outside the given list are counted under none.
    """
    response = F.col("disposition") == CANDIDATE
    seen = Observation(f"manifest-{uuid.uuid4().hex}")
    observed = files.observe(
        seen, F.count("*").alias("files"), F.count_if(F.col("disposition").isNull()).alias("undecided"), F.count_if(response).alias("responses"),
        F.count_if(response & F.col("exact_provenance")).alias("exact_provenance"),
        *[F.count_if(response & (F.col("status") == s)).alias(f"status:{s}") for s in statuses],
    )
    observed.write.parquet(path)
    return files.sparkSession.read.schema(files.schema).parquet(path), dict(seen.get)


def accounting(counts: Mapping[str, int], before: DataFrame, after: DataFrame) -> DataFrame:
    """Bookkeeping checks as rows (check_name, value): each value must be zero. Only the comparison of the files looks at rows again."""
    total = sum(n for name, n in counts.items() if name.startswith("status:"))
    spark = before.sparkSession
    counted = spark.createDataFrame(
        [("files_without_disposition", counts["undecided"]), ("responses_without_status", counts["responses"] - total)], "check_name string, value bigint"
    )
    a, b = before.select("path", _digest("sha256").alias("_a")), after.select("path", _digest("sha256").alias("_b"))
    changed = a.join(b, "path", "full_outer").agg(
        F.count_if(~F.col("_a").eqNullSafe(F.col("_b"))).alias("value")
    ).withColumn("check_name", F.lit("raw_files_changed"))
    return union_all([counted, changed.select("check_name", "value")])


def provenance_report(counts: Mapping[str, int], spark: SparkSession) -> DataFrame:
    """Verified responses, those an older store knows exactly, and their share."""
    known, all_ = counts["exact_provenance"], counts["responses"]
    share = known / all_ if all_ else None
    return spark.createDataFrame([("provenance", "exact_provenance", known, share), ("provenance", "verified_responses", all_, None)],
                                 "section string, name string, files bigint, share double")


def inventory_report(files: DataFrame) -> DataFrame:
    """File counts by disposition and by integrity problem."""
    by_disposition = files.groupBy(F.col("disposition").alias("name")).agg(F.count("*").alias("files"))
    problems = files.select(F.explode("integrity_problems").alias("name")).groupBy("name").agg(F.count("*").alias("files"))
    return union_all([
        by_disposition.withColumn("section", F.lit("disposition")),
        problems.withColumn("section", F.lit("problem")),
    ]).select("section", "name", "files")

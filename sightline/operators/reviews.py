"""Append-only event logs: review workflow and collection attempts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sightline.functions.cols import any_of, case
from sightline.operators.shape import union_all
from sightline.schemas import ACTION_STATES, ATTEMPT_TRANSITIONS, EVIDENCE_CLASSES, REVIEW_TRANSITIONS


def allowed_step(
    before: Column, after: Column, transitions: Mapping[str, Sequence[str]], stay: bool
) -> Column:
    """The transition table as one expression; ``stay`` also allows keeping a non-final state."""
    steps = [(before == s) & after.isin(*nxt) for s, nxt in transitions.items() if nxt]
    ok = any_of(*steps)
    if stay:
        ok = ok | ((before == after) & before.isin(*[s for s, nxt in transitions.items() if nxt]))
    return F.coalesce(ok, F.lit(False))


def with_previous(events: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Adds ``previous_<column>`` of the event with the sequence number before.

    An equi-join on (key, sequence) instead of a window: the events of a hot key stay spread. Of
    events that repeat a sequence number the least values count, so no event is multiplied.
    """
    least = F.min(F.struct(*[F.col(c).alias(f"previous_{c}") for c in columns])).alias("_before")
    before = (
        events.groupBy(key, (F.col("sequence") + 1).alias("sequence")).agg(least)
        .select(key, "sequence", F.lit(True).alias("_has_previous"), "_before.*")
    )
    return events.join(before, [key, "sequence"], "left").withColumn(
        "_has_previous", F.coalesce("_has_previous", F.lit(False))
    )


def repeated_sequences(events: DataFrame, key: str) -> DataFrame:
    """(key, sequence, problem) of every sequence number that more than one event has."""
    counted = events.groupBy(key, "sequence").agg(F.count("*").alias("_events")).filter("_events > 1")
    return counted.select(key, "sequence", F.lit("repeated sequence").alias("problem"))


def review_problems(events: DataFrame) -> DataFrame:
    """(opportunity_id, sequence, problem) of every event that breaks the workflow, and of every repeated number."""
    rows = with_previous(events.drop("previous_status"), "opportunity_id", ["status", "release_id"])
    first = F.col("sequence") == 1
    before, after = F.col("previous_status"), F.col("status")
    linked = F.col("_has_previous")
    blank = any_of(*[
        F.length(F.trim(F.coalesce(c, F.lit("")))) == 0 for c in ("opportunity_id", "release_id", "reviewer", "reason")
    ])
    checks = [
        F.when(blank, F.lit("missing required field")),
        F.when(~F.coalesce(after.isin(*REVIEW_TRANSITIONS), F.lit(False)), F.lit("unsupported status")),
        F.when(~F.coalesce(F.col("classification").isin(*EVIDENCE_CLASSES), F.lit(False)), F.lit("unsupported classification")),
        F.when(after.isin(*ACTION_STATES) & (F.length(F.trim(F.coalesce("next_action", F.lit("")))) == 0), F.lit("next step required")),
        F.when(~first & ~linked, F.lit("stale sequence")),
        F.when(first & (after != "new"), F.lit("first event must be new")),
        F.when(linked & (F.col("previous_release_id") != F.col("release_id")), F.lit("release changed")),
        case([
            (linked & (before == "archived"), "archived is final"),
            (linked & ~allowed_step(before, after, REVIEW_TRANSITIONS, stay=True), "invalid transition"),
        ]),
    ]
    found = rows.select(
        "opportunity_id", "sequence", F.explode(F.array_compact(F.array(*checks))).alias("problem")
    )
    return found.unionByName(repeated_sequences(events, "opportunity_id"))


def unknown_references(events: DataFrame, evidence: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Evidence references of events that are in none of the relations of their release.

    Each relation carries release_id and the named id column.
    """
    known = union_all([df.select("release_id", F.col(c).alias("reference")) for df, c in evidence]).distinct()
    cited = events.select(
        "opportunity_id", "sequence", "release_id",
        F.explode(F.from_json("evidence_json", "array<string>")).alias("reference"),
    )
    return cited.join(known, ["release_id", "reference"], "left_anti")


def review_history(events: DataFrame, opportunity_id: str | None = None) -> DataFrame:
    rows = events if opportunity_id is None else events.filter(F.col("opportunity_id") == opportunity_id)
    return rows.orderBy("opportunity_id", "sequence")


def latest_reviews(events: DataFrame) -> DataFrame:
    """Current state of every opportunity (partial aggregation, no per-key sort)."""
    newest = F.max(F.struct("sequence", "status", "release_id")).alias("_e")
    return events.groupBy("opportunity_id").agg(newest).select("opportunity_id", "_e.*")


def attempt_problems(events: DataFrame) -> DataFrame:
    """State changes of collection attempts that the state machine does not allow."""
    rows = with_previous(events, "attempt_id", ["status"])
    first = F.col("sequence") == 1
    checks = [
        F.when(first & (F.col("status") != "planned"), F.lit("must start planned")),
        F.when(~first & ~F.col("_has_previous"), F.lit("gap in history")),
        F.when(
            F.col("_has_previous") & ~allowed_step(F.col("previous_status"), F.col("status"), ATTEMPT_TRANSITIONS, stay=False),
            F.lit("illegal transition"),
        ),
    ]
    found = rows.select("attempt_id", "sequence", F.explode(F.array_compact(F.array(*checks))).alias("problem"))
    return found.unionByName(repeated_sequences(events, "attempt_id"))

"""Human decisions on results: final rows, their summary, audit and quality gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DECISIONS, STATUSES
from ..functions import urls
from ..functions.text import append_note, blank
from .providers import lookup

CARRIED = ["confidence", "evidence_summary", "candidate_count", "scored_candidate_count", "service_apis", "provider_locations"]


def decision_of(decision: Column, manual_url: Column, words: dict[str, str] = DECISIONS) -> Column:
    """accept, replace or reject; blank with an address is replace; blank; or invalid:<word>."""
    raw = F.lower(F.trim(blank(decision)))
    known = F.create_map(*[F.lit(x) for kv in words.items() for x in kv])
    said = F.coalesce(F.try_element_at(known, raw), F.concat(F.lit("invalid:"), raw))
    return F.when((raw == "") & (F.trim(blank(manual_url)) != ""), F.lit("replace")).when(raw == "", F.lit("")).otherwise(said)


def ensure_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Missing columns as empty strings."""
    return df.withColumns({c: F.lit("") for c in names if c not in df.columns})


def finalize(results: DataFrame, decisions: DataFrame) -> DataFrame:
    """A final row per result: what the decision on it says, else its match, else pending review."""
    base = ["provider_id", "provider_name", "official_url", "official_domain", "status", *CARRIED]
    rows = lookup(ensure_columns(results, base), ensure_columns(decisions, ["provider_id", "provider_name", "manual_decision", "manual_url", "official_url", "candidate_1_url", "notes", "source_status", *CARRIED]))
    r = lambda c: blank(F.col(f"found.{c}"))
    decision = decision_of(F.col("found.manual_decision"), F.col("found.manual_url"))
    own = F.coalesce(*[F.nullif(x, F.lit("")) for x in (r("manual_url"), r("official_url"), r("candidate_1_url"), blank(F.col("official_url")))], F.lit(""))
    rows = rows.withColumn("__d", decision).withColumn("__u", urls.delivered(F.when(F.col("__d") == "accept", own).otherwise(r("manual_url"))))
    rows = rows.withColumn("__m", urls.delivered(F.col("official_url")))
    d, notes = F.col("__d"), F.trim(r("notes"))
    positive, invalid, match = d.isin("accept", "replace"), d.startswith("invalid:"), F.col("status") == "matched"
    good = positive & (F.col("__u") != "")
    auto = (d == "") & match
    status = F.when(d == "reject", "rejected").when(good, "manual_accepted").when(positive, "unresolved").when(invalid, "invalid_manual_decision").when(match, "matched").otherwise("unresolved")
    source = (
        F.when(d == "reject", F.lit("manual_reject"))
        .when(good, F.concat(F.lit("manual_"), d))
        .when(positive, F.concat(F.lit("manual_"), d, F.lit("_missing_url")))
        .when(invalid, F.lit("invalid_manual_decision"))
        .when(match, F.lit("auto_matched"))
        .otherwise("pending_review")
    )
    note = F.when(positive & ~good, append_note(notes, F.concat(F.lit("manual_"), d, F.lit("_missing_url")))).when(invalid, append_note(notes, d)).otherwise(notes)
    url = F.when(good, F.col("__u")).when(auto, F.col("__m")).otherwise("")
    host = F.when(good, urls.domain(F.col("__u"))).when(auto & (F.col("__m") != ""), urls.domain(F.coalesce(F.nullif(blank(F.col("official_domain")), F.lit("")), F.col("__m")))).otherwise("")
    carried = [F.when(good & (r(c) != ""), r(c)).otherwise(blank(F.col(c).cast("string"))).alias(c) for c in CARRIED]
    source_status = F.when(good & (r("source_status") != ""), r("source_status")).otherwise(blank(F.col("status")))
    return rows.select("provider_id", "provider_name", url.alias("official_url"), host.alias("official_domain"), status.alias("status"), source.alias("decision_source"), source_status.alias("source_status"), *carried, note.alias("notes"))


def unresolved(final: DataFrame) -> DataFrame:
    return final.filter((F.col("official_url") == "") | (F.col("status") == "rejected"))


def final_summary(final: DataFrame) -> DataFrame:
    """Rows by status and decision source."""
    return final.groupBy("status", "decision_source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("official_url") != "").alias("official_url_rows"))


def audit(results: DataFrame) -> DataFrame:
    """Per status: rows, and the least, largest and mean confidence of the rows that have one."""
    c = F.when(F.trim(blank(F.col("confidence").cast("string"))) != "", F.col("confidence").cast("string").try_cast("double"))
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.min(c).alias("min_confidence"), F.max(c).alias("max_confidence"), F.round(F.avg(c), 1).alias("avg_confidence"))


def review_queue(results: DataFrame, pos: str = "pos") -> DataFrame:
    """needs_review rows, then low_confidence and not_found ones, each in input order (column queue_pos orders both)."""
    order = F.when(F.col("status") == "needs_review", 0).when(F.col("status").isin("low_confidence", "not_found"), 1)
    return results.withColumn("queue", order).filter(F.col("queue").isNotNull()).withColumn("queue_pos", F.struct("queue", pos))


def quality_gate(final: DataFrame, patterns: list[str], least_url_rate: float = 0.5, most_unresolved_rate: float = 0.6) -> DataFrame:
    """One row: counts of what is wrong, rates, and the failures they make. Duplicates take one grouped count, the rest one pass."""
    accepted = F.col("status").isin("matched", "manual_accepted", "calibrated_released")
    has_url = blank(F.col("official_url")) != ""
    malformed = has_url & ~F.col("official_url").rlike(r"^https?://[^/\s.]+\.[^\s]+$")
    counts = final.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(has_url).alias("official_url_rows"),
        F.count_if(~has_url | (F.col("status") == "rejected")).alias("unresolved_rows"),
        F.count_if(~F.col("status").isin(STATUSES)).alias("unknown_statuses"),
        F.count_if(has_url & urls.excluded(F.col("official_url"), patterns)).alias("excluded_urls"),
        F.count_if(malformed).alias("malformed_urls"),
        F.count_if(accepted & ~has_url).alias("accepted_without_url"),
        F.count_if(F.col("status") == "invalid_manual_decision").alias("invalid_decisions"),
    )
    repeated = final.filter(F.trim(blank(F.col("provider_id"))) != "").groupBy("provider_id").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.col("n") > 1).alias("duplicate_ids"))
    one = counts.crossJoin(F.broadcast(repeated))
    one = one.withColumns({"url_rate": F.round(F.try_divide("official_url_rows", "rows"), 3), "unresolved_rate": F.round(F.try_divide("unresolved_rows", "rows"), 3)})
    failing = [F.when(F.col(c) > 0, F.lit(c)) for c in ("duplicate_ids", "unknown_statuses", "excluded_urls", "malformed_urls", "accepted_without_url", "invalid_decisions")]
    failing += [F.when(F.col("url_rate") < least_url_rate, F.lit("url_rate")), F.when(F.col("unresolved_rate") > most_unresolved_rate, F.lit("unresolved_rate"))]
    return one.withColumn("failures", F.array_join(F.array_compact(F.array(*failing)), "; "))

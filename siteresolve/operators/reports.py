"""Reports over verification rows, lanes and second-pass results: counts, rates, repeated causes, fixtures, deltas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import blank, first_filled, whole_number
from .balance import matched_to, ratio

DECISION_NAMES = ["accept", "replace", "reject", "unsure"]
DELTA_METRICS = ["overall_accuracy", "auto_precision", "official_recall", "false_official_rows", "over_rejected_rows", "official_output_rows", "correct_official_rows"]
# Hosts that one rejection is enough to exclude.
BAD_HOSTS = ["linkedin.com", "facebook.com", "instagram.com", "youtube.com", "crunchbase.com", "trustpilot.com", "clutch.co"]


def verification_balance(details: DataFrame, checks: DataFrame) -> DataFrame:
    """One row: what verification does to labelled rows (wrong sites caught or accepted, right ones accepted, lost ones recovered)."""
    rows = matched_to(details, checks).filter(F.col("row").isNotNull())
    d = blank(F.col("row.decision"))
    suggested = F.when(d == "accept", urls.domain(F.col("row.candidate_url"))).when(d == "replace", urls.domain(F.col("row.replacement_url"))).otherwise("")
    rows = rows.withColumns({"d": d, "s": suggested})
    d, s, o = F.col("d"), F.col("s"), F.col("outcome")
    false, right, lost, none = o == "false_official", o == "correct_official", o == "over_rejected", F.col("expected_kind") == "no_official"
    one = rows.agg(
        F.count(F.lit(1)).alias("checked_rows"),
        *[F.count_if(d == n).alias(f"{n}_rows") for n in DECISION_NAMES],
        F.count_if(false).alias("false_official_rows"),
        F.count_if(false & ~d.isin("", "accept")).alias("false_official_caught_rows"),
        F.count_if(false & (d == "accept")).alias("false_official_accept_rows"),
        F.count_if(right).alias("correct_official_rows"),
        F.count_if(right & (d == "accept")).alias("correct_official_accept_rows"),
        F.count_if(none).alias("expected_no_official_rows"),
        F.count_if(none & d.isin("accept", "replace")).alias("no_official_accept_or_replace_rows"),
        F.count_if(lost).alias("over_rejected_rows"),
        F.count_if(lost & (s != "") & (s == F.col("expected_domain"))).alias("correct_recovery_rows"),
        F.count_if(lost & (s != "") & (s != F.col("expected_domain"))).alias("wrong_recovery_rows"),
        F.count_if(lost & (s == "")).alias("hold_rows"),
    )
    share = lambda a, b: ratio(F.col(a), F.col(b))
    return one.withColumns(
        {
            "catch_rate": share("false_official_caught_rows", "false_official_rows"),
            "accept_rate": share("correct_official_accept_rows", "correct_official_rows"),
            "recovery_rate": share("correct_recovery_rows", "over_rejected_rows"),
        }
    )


def verification_summary(checks: DataFrame) -> DataFrame:
    """Rows per review reason and decision, timeouts, and the decisions' shares; the row with a null reason is the total (a roll-up, one shuffle)."""
    d = blank(F.col("decision"))
    one = checks.withColumn("review_reason", blank(F.col("review_reason"))).rollup("review_reason").agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(d == n).alias(f"{n}_rows") for n in DECISION_NAMES], F.count_if(F.col("reason_for_unsure") == "agent_b_row_timeout").alias("timeout_rows")
    )
    return one.withColumns({f"{n}_rate": ratio(F.col(f"{n}_rows"), F.col("rows")) for n in ("accept", "replace", "unsure", "timeout")})


def rejected_domains(checks: DataFrame, least: int = 2) -> DataFrame:
    """domain, rejections: domains rejected at least ``least`` times, or once if they are known not to be company sites."""
    counts = checks.filter(F.col("decision") == "reject").groupBy(urls.domain(F.col("candidate_url")).alias("domain")).agg(F.count(F.lit(1)).alias("rejections"))
    return counts.filter((F.col("domain") != "") & ((F.col("rejections") >= least) | urls.excluded(F.col("domain"), BAD_HOSTS)))


def replacement_queries(checks: DataFrame, least: int = 2) -> DataFrame:
    """query, replacements: search queries that led to a replacement at least ``least`` times."""
    asked = checks.filter(F.col("decision") == "replace").select(F.explode(F.split(blank(F.col("independent_search_queries")), ";")).alias("q")).select(F.trim("q").alias("query")).filter("query <> ''")
    return asked.groupBy("query").agg(F.count(F.lit(1)).alias("replacements")).filter(F.col("replacements") >= least)


def doubts(checks: DataFrame) -> DataFrame:
    """One row: low_score_accepts (below 70) and name_conflicts (unsure, a counter-fact about the name, or a conflict as the reason)."""
    d, score = F.col("decision"), whole_number(F.col("evidence_score").cast("string"))
    return checks.agg(F.count_if((d == "accept") & (score < 70)).alias("low_score_accepts"), F.count_if(_conflict()).alias("name_conflicts"))


def _conflict():
    return F.lower(blank(F.col("counter_evidence"))).contains("name") | F.lower(blank(F.col("reason_for_unsure"))).contains("conflict") | (F.col("decision") == "unsure")


def verification_recommendations(checks: DataFrame, learned_domains: DataFrame | None = None, least_accepts: int = 2, least_conflicts: int = 3, examples: int = 50, shown_queries: int = 10, pos: str = "pos") -> DataFrame:
    """kind, action, domain, n, safe_to_apply, examples: what verification rows recommend.

    excluded_domain: a row per domain rejected again and again or known as no company's site, and per domain of ``learned_domains`` (domain) that has none yet; second_pass_query: queries
    that led to replacements more than once (``examples``: the first by name); threshold_review and identity_constraint: rows in doubt, if there are enough (examples: ids of the first
    by ``pos``); labels_only, if nothing else is recommended and there are rows at all. Groupings and one pass; what is listed is cut task by task.
    """
    none = F.array().cast("array<string>")
    row = lambda df, kind, action, safe, domain=F.lit(""), listed=none: df.select(F.lit(kind).alias("kind"), F.lit(action).alias("action"), domain.alias("domain"), F.col("n").cast("long").alias("n"), F.lit(safe).alias("safe_to_apply"), listed.alias("examples"))
    domains = row(rejected_domains(checks).withColumnRenamed("rejections", "n"), "excluded_domain", "add_to_excluded_domains", True, F.col("domain"))
    if learned_domains is not None:
        more = learned_domains.select(blank(F.col("domain")).alias("domain")).filter("domain <> ''").distinct().join(domains.select("domain"), "domain", "left_anti").withColumn("n", F.lit(1))
        domains = domains.unionByName(row(more, "excluded_domain", "add_to_excluded_domains", True, F.col("domain")))
    asked = replacement_queries(checks)
    first = asked.orderBy("query").limit(shown_queries).agg(F.sort_array(F.collect_list("query")).alias("l"))
    queries = row(asked.agg(F.sum("replacements").alias("n")).filter("n > 0").crossJoin(first), "second_pass_query", "review_second_pass_query_templates", False, listed=F.col("l"))
    counts = doubts(checks)
    accepts = row(counts.select(F.col("low_score_accepts").alias("n")).filter(F.col("n") >= least_accepts), "threshold_review", "evaluate_strong_evidence_rule_or_threshold", False)
    doubted = checks.filter(_conflict()).orderBy(pos).limit(examples).agg(F.transform(F.sort_array(F.collect_list(F.struct(F.col(pos).alias("p"), blank(F.col("provider_id")).alias("i")))), lambda x: x["i"]).alias("l"))
    identity = row(counts.select(F.col("name_conflicts").alias("n")).filter(F.col("n") >= least_conflicts).crossJoin(doubted), "identity_constraint", "write_identity_regression_fixtures", False, listed=F.col("l"))
    found = domains.unionByName(queries).unionByName(accepts).unionByName(identity)
    # one-row sides: whether anything was found, and whether there are rows
    alone = checks.agg(F.count(F.lit(1)).alias("rows")).crossJoin(found.agg(F.count(F.lit(1)).alias("found"))).filter("rows > 0 AND found = 0").withColumn("n", F.lit(0))
    return found.unionByName(row(alone, "labels_only", "keep_as_labels_and_evidence", False))


def identity_fixtures(checks: DataFrame, pos: str = "pos") -> DataFrame:
    """The first row in doubt per provider and candidate address, with the outcome that a regression run expects of it."""
    kept = ["candidate_url", "decision", "evidence_score", "counter_evidence", "reason_for_unsure"]
    rows = checks.filter(_conflict()).withColumn("__u", blank(F.col("candidate_url")))
    one = rows.groupBy("provider_id", "__u").agg(F.min_by(F.struct(*kept), pos).alias("r"))
    return one.select("provider_id", "r.*", F.lit("needs_identity_review").alias("expected_outcome"))


def lane_policy(lanes: DataFrame) -> DataFrame:
    """Per lane (review_lanes): policy protected, spot_check or more_labels, and why. A lane is protected if dropping it misses a known error."""
    false, lost = F.col("false_official_rows"), F.col("over_rejected_rows")
    right = F.col("correct_official_rows") + F.col("correct_no_official_rows")
    why = F.concat_ws(
        "; ",
        F.when(false > 0, F.concat(F.lit("would miss "), false.cast("string"), F.lit(" labeled false official row(s)"))),
        F.when(lost > 0, F.concat(F.lit("would miss "), lost.cast("string"), F.lit(" labeled over-rejected official row(s)"))),
    )
    clean = (F.col("labeled_rows") >= 3) & (right >= F.col("labeled_rows"))
    return lanes.filter(blank(F.col("review_reason")) != "").select(
        "review_reason",
        "review_task_rows",
        "risk_rows",
        F.when((false > 0) | (lost > 0), "protected").when(clean, "spot_check").otherwise("more_labels").alias("policy"),
        F.when((false > 0) | (lost > 0), why).when(clean, "labeled rows are clean so far; keep as sampled spot-check before removing").otherwise("not enough labeled evidence to remove or keep permanently").alias("reason"),
    )


def metric_deltas(baseline: DataFrame, calibrated: DataFrame) -> DataFrame:
    """metric, baseline, calibrated, delta for two one-row summaries: two rows are joined, whatever the data's size."""
    long = lambda df, name: df.select(F.explode(F.create_map(*[x for m in DELTA_METRICS for x in (F.lit(m), F.col(m).cast("double"))])).alias("metric", name))
    both = long(baseline, "baseline").join(long(calibrated, "calibrated"), "metric")
    return both.withColumn("delta", F.round(F.col("calibrated") - F.col("baseline"), 4))


def collected(queries: DataFrame, found: DataFrame) -> DataFrame:
    """Candidates of each query's search results (query, source_pos, rank, url, title, snippet, source), ordered by query, source and rank: an equi-join on the query."""
    rows = queries.join(found, "query")
    order = F.struct("query_pos", "source_pos", "rank")
    return rows.select("provider_id", order.alias("pos"), *[c for c in found.columns if c not in ("source_pos", "rank")])


def with_rescue(first: DataFrame, rescued: DataFrame) -> DataFrame:
    """Second-pass results (provider_id, accepted, ...) where a row that isn't accepted gives way to its accepted rescue; rescue_used tells."""
    names = [c for c in first.columns if c != "provider_id"]
    better = rescued.filter("accepted").select("provider_id", F.struct(*names).alias("__r"))
    rows = first.join(better, "provider_id", "left").withColumn("rescue_used", ~F.col("accepted") & F.col("__r").isNotNull())
    return rows.select("provider_id", *[F.when(F.col("rescue_used"), F.col(f"__r.{c}")).otherwise(F.col(c)).alias(c) for c in names], "rescue_used")


def second_pass_rows(planned: DataFrame, results: DataFrame) -> DataFrame:
    """Output rows of the second pass: the plan's row with the result, accepted_for_final and a note. Needs results with accepted and rescue_used."""
    r = results.select("provider_id", *[F.col(c).alias(f"__{c}") for c in ("official_url", "confidence", "status", "accepted", "rescue_used")])
    note = F.when(F.col("__accepted") & F.col("__rescue_used"), "second_pass_rescue_verify_accept").when(F.col("__accepted"), "second_pass_auto_accept").otherwise("second_pass_review_required")
    return planned.join(r, "provider_id").select(
        "provider_id",
        "strategy_tier",
        F.col("status").alias("previous_status"),
        blank(F.col("confidence").cast("string")).alias("previous_confidence"),
        blank(F.col("__official_url")).alias("official_url"),
        urls.domain(first_filled(F.col("__official_url"))).alias("official_domain"),
        blank(F.col("__confidence").cast("string")).alias("confidence"),
        F.col("__status").alias("status"),
        F.col("__accepted").cast("string").alias("accepted_for_final"),
        note.alias("notes"),
    )


def second_pass_decisions(rows: DataFrame) -> DataFrame:
    """Replace decisions of the accepted output rows."""
    said = F.concat("notes", F.lit(" confidence="), "confidence", F.lit(" tier="), blank(F.col("strategy_tier")))
    return rows.filter("accepted_for_final = 'true'").select("provider_id", F.lit("replace").alias("manual_decision"), F.col("official_url").alias("manual_url"), said.alias("notes"), "confidence", F.col("status").alias("source_status"))

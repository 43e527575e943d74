"""What filled samples say about patterns, lanes and policies, and how many more labels are worth having."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import urls
from ..functions.text import blank
from .balance import ratio, wilson

SUPPORT = ["candidate_correct", "recall_candidate_useful"]
BLOCK = ["candidate_incorrect", "recall_candidate_not_useful"]
LEAST_CLEAN = 5
RECALL_THRESHOLDS = [0, 30, 45, 50, 60, 70, 75, 80, 85]

# What reviewers' notes say, by tag.
NOTE_TAGS = {
    "confirmed_no_official": ["实际无官网", "no official", "no reliable official"],
    "wrong_company": ["错误官网", "wrong official", "wrong website"],
    "recall_gap": ["没找到官网", "未找到官网", "not found official", "recall gap"],
    "candidate_unreachable": ["无法打开", "打不开", "无法访问", "not open", "not working", "does not open", "timeout"],
    "platform_profile_only": ["平台 profile", "平台profile", "平台页", "店铺页", "linkedin", "indiamart", "amazon listing", "社媒"],
    "other_company": ["不是", "另一个", "无关", "公司不同", "同名"],
    "service_mismatch": ["服务内容不匹配", "服务类型", "业务类型", "具体内容不一致", "内容完全不一致", "行业", "主营业务"],
    "region_mismatch": ["地区不匹配", "国家", "provider location", "tld", "域名后缀"],
    "name_or_logo_mismatch": ["名字不一致", "名称不一致", "logo不一致", "logo 和名字", "logo和名字", "品牌不匹配"],
    "insufficient_evidence": ["不完全确定", "不确定", "缺少证据", "无法确认", "证据"],
}


def note_tags(notes: Column, candidate_url: Column, manual_url: Column, decision: Column, error_type: Column) -> Column:
    """Distinct tags of a note, in the order of the rules."""
    said = F.lower(F.concat_ws(" ", blank(notes), blank(error_type)))
    candidate = blank(candidate_url) != ""

    def has(tag: str) -> Column:
        return F.exists(F.array(*map(F.lit, NOTE_TAGS[tag])), lambda w: said.contains(w))

    same = candidate & (blank(manual_url) != "") & (urls.domain(candidate_url) == urls.domain(manual_url))
    rules = [
        (has("confirmed_no_official") & candidate, "wrong_candidate_no_replacement"),
        (has("confirmed_no_official"), "confirmed_no_official"),
        (has("wrong_company"), "wrong_company"),
        (has("recall_gap"), "recall_gap"),
        (has("candidate_unreachable"), "candidate_unreachable"),
        (same, "domain_variant_fix"),
        (has("platform_profile_only"), "platform_profile_only"),
        (has("other_company"), "wrong_company"),
        *((has(t), t) for t in ("service_mismatch", "region_mismatch", "name_or_logo_mismatch")),
        (has("insufficient_evidence") | (decision == "unsure"), "insufficient_evidence"),
    ]
    return F.array_distinct(F.array_compact(F.array(*[F.when(c, F.lit(tag)) for c, tag in rules])))


def recommendation(good: Column, bad: Column) -> Column:
    return F.when(bad > 0, "reject_pattern").when(good >= LEAST_CLEAN, "candidate_for_rule").when(good > 0, "needs_more_labels").otherwise("unlabeled")


def pattern_recommendations(details: DataFrame, by: str = "pattern_match", pos: str = "pos") -> DataFrame:
    """Per pattern of a filled sample: rows, labelled, decisive, supporting and blocking ones, rates, bounds and what to do with it.

    Labels with a quality issue count as neither labelled nor decisive.
    """
    valid = blank(F.col("decision_quality_issue")) == ""
    one = details.filter(blank(F.col(by)) != "").groupBy(F.col(by).alias("pattern")).agg(
        F.min_by(blank(F.col("pattern_scope")), pos).alias("pattern_scope"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(valid & (blank(F.col("normalized_decision")) != "")).alias("labeled_rows"),
        F.count_if(valid & F.col("calibration_outcome").isin(SUPPORT)).alias("supporting_rows"),
        F.count_if(valid & F.col("calibration_outcome").isin(BLOCK)).alias("blocking_rows"),
    )
    one = one.withColumn("decisive_rows", F.col("supporting_rows") + F.col("blocking_rows"))
    low, _ = wilson(F.col("supporting_rows"), F.col("decisive_rows"))
    _, high = wilson(F.col("blocking_rows"), F.col("decisive_rows"))
    return one.withColumns(
        {
            "support_rate": ratio(F.col("supporting_rows"), F.col("decisive_rows")),
            "support_rate_wilson_lower_80": low,
            "blocking_rate_wilson_upper_80": high,
            "recommendation": recommendation(F.col("supporting_rows"), F.col("blocking_rows")),
        }
    )


def recall_releases(rows: DataFrame, thresholds: list[int] | None = None) -> DataFrame:
    """Per evidence threshold: rows of the recall lane it would release, right and wrong ones, and right ones it would hold.

    ``rows``: expected_kind, expected_domain, candidate_domain, candidate_score; rows without a candidate's domain don't take part. One grouped pass over rows x thresholds.
    """
    own = rows.filter(blank(F.col("candidate_domain")) != "")
    right = (F.col("expected_kind") == "official") & (F.col("candidate_domain") == F.col("expected_domain"))
    each = own.select(F.explode(F.array(*map(F.lit, thresholds or RECALL_THRESHOLDS))).alias("evidence_threshold"), right.alias("right"), (F.col("expected_kind") == "official").alias("official"), F.coalesce("candidate_score", F.lit(0)).alias("score"))
    out = F.col("score") >= F.col("evidence_threshold")
    one = each.groupBy("evidence_threshold").agg(
        F.count(F.lit(1)).alias("recall_rows"),
        F.count_if("official").alias("expected_official_rows"),
        F.count_if(out).alias("release_rows"),
        F.count_if(out & F.col("right")).alias("correct_recovery_rows"),
        F.count_if(out & ~F.col("right")).alias("wrong_release_rows"),
        F.count_if(~out & F.col("right")).alias("held_correct_recovery_rows"),
    )
    c = F.col
    return one.withColumns({"release_precision": ratio(c("correct_recovery_rows"), c("release_rows")), "official_recovery_rate": ratio(c("correct_recovery_rows"), c("expected_official_rows"))})


def label_targets(lanes: DataFrame, needs_more: list[str], spot_check: list[str], protected: list[str]) -> DataFrame:
    """Lanes (review_reason, rows, decisive_rows, recommendation or blank) with priority, target and how many decisive labels are still needed."""
    c = F.col
    more, spot, kept = (c("review_reason").isin(x) if x else F.lit(False) for x in (needs_more, spot_check, protected))
    given = F.coalesce(F.nullif(blank(c("recommendation")), F.lit("")), F.when(more, "needs_more_labels").when(spot, "spot_check_candidate").when(kept, "keep_review_lane").otherwise("needs_more_labels"))
    rows = lanes.filter(blank(c("review_reason")) != "").withColumn("recommendation", given)
    few = ~more & (spot | kept | c("recommendation").isin("spot_check_candidate", "keep_review_lane"))
    target = F.least(c("rows"), F.when(few, 3).otherwise(5))
    priority = F.when(more | (c("recommendation") == "candidate_for_review_downgrade"), "high").when(spot | kept | c("recommendation").isin("spot_check_candidate", "keep_review_lane"), "medium").otherwise("normal")
    rows = rows.withColumns({"priority": priority, "target_decisive_rows": F.when(c("rows") <= 0, 0).otherwise(target)})
    return rows.withColumn("decisive_rows_needed", F.greatest(F.lit(0), c("target_decisive_rows") - c("decisive_rows")))


def policy_outcome(decision: Column, action: Column, candidate_url: Column, manual_url: Column) -> Column:
    """What a reviewer's decision says about holding a row back or releasing it."""
    act = F.lower(blank(action))
    released = (decision == "accept") | ((decision == "replace") & urls.same_site(candidate_url, manual_url))
    return (
        F.when(blank(decision) == "", "unlabeled")
        .when(decision == "unsure", "manual_unsure")
        .when(act == "holdout", F.when(decision == "accept", "holdout_blocked").otherwise("holdout_supported"))
        .when(act == "release", F.when(released, "release_supported").otherwise("release_blocked"))
        .otherwise("unlabeled")
    )

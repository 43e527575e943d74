"""Review work: sheets, tasks, samples, label reuse."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import blank, first_filled
from ..storage import written
from .finalize import ensure_columns
from .providers import cut_per_key, entity_key


def review_sheet(candidates: DataFrame, top: int = 5, pos: str = "pos") -> DataFrame:
    """Per provider its best candidates side by side: candidate_<k>_url, _domain, _score. Rejected ones rank last at -100."""
    score = F.when(F.col("reject"), F.lit(-100)).otherwise(F.col("score"))
    ranked = cut_per_key(candidates.withColumn("score", score), ["provider_id"], [F.desc("score"), F.col(pos)], top)
    listed = ranked.groupBy("provider_id").agg(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("o"), F.col(pos).alias("p"), "url", "domain", "score"))).alias("c"))
    cols = [F.get("c", F.lit(k))[f].alias(f"candidate_{k + 1}_{f}") for k in range(top) for f in ("url", "domain", "score")]
    return listed.select("provider_id", *cols)


def round_robin(rows: DataFrame, group: str, order: list, total: int, per_group: int) -> DataFrame:
    """A sample that takes turns over the groups (best first by score): the n-th row of each group before any n+1-th. Columns turn and group_rank say how."""
    w = Window.partitionBy(group).orderBy(*order)
    ranked = rows.withColumn("turn", F.row_number().over(w)).filter(F.col("turn") <= per_group)
    best = ranked.groupBy(group).agg(F.max("score").alias("best"))
    places = best.withColumn("group_rank", F.row_number().over(Window.orderBy(F.desc("best"), group))).drop("best")
    return ranked.join(places, group).orderBy("turn", "group_rank").limit(total)


def top_per_group(rows: DataFrame, group: str, order: list, per_group: int) -> DataFrame:
    return cut_per_key(rows, [group], order, per_group)


def label_gap(rows: DataFrame, targets: DataFrame, group: str, pos: str = "pos") -> DataFrame:
    """The first rows of each group, as many as ``targets`` (group, needed) still asks for."""
    ranked = rows.withColumn("__n", F.row_number().over(Window.partitionBy(group).orderBy(pos)))
    return ranked.join(targets, group).filter(F.col("__n") <= F.col("needed")).drop("__n", "needed")


def unfilled(task: DataFrame, filled: DataFrame, by_reason: bool = False) -> DataFrame:
    """Task rows that aren't filled yet. A filled provider id takes all rows of that provider out, or with ``by_reason`` those of the same review reason only; providers without an id
    are told by their name in any case, always with the reason. Rows with neither stay. Two equi-joins; blank keys never meet.
    """
    done = ensure_columns(filled, ["provider_name", "review_reason", "manual_decision", "your_decision", "decision"])
    said = first_filled(F.col("manual_decision"), F.col("your_decision"), F.col("decision"))
    done = done.filter(F.trim(said) != "") if {"manual_decision", "your_decision", "decision"} & set(filled.columns) else done
    rows = ensure_columns(task, ["provider_name", "review_reason"])
    out = rows
    if not by_reason:
        out = out.join(done.select("provider_id").filter(F.trim(blank(F.col("provider_id"))) != "").distinct(), "provider_id", "left_anti")
    key = lambda: F.concat_ws("\u0001", entity_key(), F.trim(blank(F.col("review_reason"))))
    keys = done.filter(entity_key() != "").select(key().alias("__key")).distinct()
    alone = F.concat(F.lit("\u0002"), F.monotonically_increasing_id().cast("string"))
    out = out.withColumn("__key", F.when(entity_key() != "", key()).otherwise(alone)).join(keys, "__key", "left_anti")
    return out.select(task.columns)


def merge_samples(samples: DataFrame, seq: str = "seq") -> DataFrame:
    """One row per provider and reason over several filled samples: a filled one beats a blank one, a later one an earlier."""
    order = F.struct((F.trim(blank(F.col("manual_decision"))) != "").alias("has"), F.col(seq).alias("s"))
    return samples.groupBy("provider_id", "review_reason").agg(F.max_by(F.struct(*samples.columns), order).alias("r")).select("r.*")


def reuse_labels(task: DataFrame, labels: DataFrame, pos: str = "pos") -> DataFrame:
    """Task rows with label_state none, reused or conflict, and the reused decision and address."""
    one = labels.filter(blank(F.col("provider_id")) != "").groupBy("provider_id").agg(
        F.count_distinct(F.struct("manual_decision", "manual_url")).alias("k"), F.min_by(F.struct("manual_decision", "manual_url"), pos).alias("l")
    )
    rows = task.join(one, "provider_id", "left")
    state = F.when(F.col("k").isNull(), "none").when(F.col("k") == 1, "reused").otherwise("conflict")
    value = lambda c: F.when(state == "reused", F.col(f"l.{c}")).otherwise("")
    return rows.select(*task.columns, state.alias("label_state"), value("manual_decision").alias("reused_decision"), value("manual_url").alias("reused_url"))


def domain_feedback(decisions: DataFrame, known: list[str]) -> DataFrame:
    """Per domain its accepted and rejected rows, and whether it may be excluded from now on: rejected twice or more, never accepted, not excluded yet."""
    one = decisions.filter(blank(F.col("domain")) != "").groupBy("domain").agg(F.count_if(F.col("decision").isin("accept", "replace")).alias("accepted"), F.count_if(F.col("decision") == "reject").alias("rejected"))
    return one.withColumn("exclude", (F.col("rejected") >= 2) & (F.col("accepted") == 0) & ~F.col("domain").isin(known))


def _nth(rows: DataFrame, group: str, cap: str, name: str) -> DataFrame:
    """Per group the place of its row number ``cap`` (a column), where it has so many. Only rows up to the cap leave a task before groups meet."""
    place = F.row_number().over(Window.partitionBy(group).orderBy("__at"))
    return rows.withColumn("__n", place).filter(F.col("__n") == F.col(cap)).select(F.col(group).alias(f"__{name}"), F.col("__at").alias(f"__{name}_at"))


def _upto(rows: DataFrame, ends: DataFrame, group: str, name: str) -> DataFrame:
    """Rows at or before the end of their group; groups without one are open."""
    end = F.col(f"__{name}_at")
    return rows.join(ends, F.col(group).eqNullSafe(F.col(f"__{name}")), "left").filter(end.isNull() | (F.col("__at") <= end)).drop(f"__{name}", f"__{name}_at")


def filled(rows: DataFrame, a: str, b: str) -> DataFrame:
    """What a walk in order of __at takes if each group of column ``a`` and each of column ``b`` is closed after as many rows as columns __cap_a and __cap_b say (null: never; 0: from the start).

    A group closes at one place, and a row is taken exactly if neither of its groups has closed before it. With places that are too early for one column's groups, those of the other
    come out too late, and the reverse; so both are tightened in turn from both sides until they agree. Every turn fixes at least the next closing place, and most turns many.
    """
    rows = rows.filter((F.coalesce("__cap_a", F.lit(1)) > 0) & (F.coalesce("__cap_b", F.lit(1)) > 0))
    slim = rows.select(F.col(a).alias("a"), F.col(b).alias("b"), "__at", "__cap_a", "__cap_b")
    early = written(_nth(slim, "a", "__cap_a", "a"), "ends"), written(_nth(slim, "b", "__cap_b", "b"), "ends")

    def other(ends: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
        return written(_nth(_upto(slim, ends[1], "b", "b"), "a", "__cap_a", "a"), "ends"), written(_nth(_upto(slim, ends[0], "a", "a"), "b", "__cap_b", "b"), "ends")

    while True:
        late = other(early)
        if all(x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty() for x, y in zip(early, late)):
            return _upto(_upto(rows, early[0], a, "a"), early[1], b, "b")
        early = other(late)


def balanced_sample(rows: DataFrame, order: list, most: int, per_reason: int, per_pattern: int = 0, key: str | None = None) -> DataFrame:
    """A greedy sample in priority order under three caps (0: none, but for ``most``), with sample_pos. Needs review_reason and pattern_match; rows without a pattern have no pattern cap.

    The first walk takes rows until their reason, their pattern or the sample is full; the second fills up past the pattern cap with rows whose ``key`` (by default each row is its
    own) isn't in the sample yet. Both are ``filled`` with two caps; what is left of ``most`` then cuts the walk. Rows of equal order come in any, but one, order.

    Of one reason and pattern no more than the reason's cap can be taken, so the rest goes first, task by task. Places in the order come from a range sort; nothing is sorted in
    one task but the sample itself.
    """
    cap = min(per_reason or most, most)
    both = ["review_reason", "pattern_match"]
    given = rows.withColumn("__key", F.xxhash64(F.monotonically_increasing_id()) if key is None else F.col(key))
    given = written(given.orderBy(*order).withColumn("__at", F.monotonically_increasing_id()), "ordered")
    few = given.withColumn("__n", F.row_number().over(Window.partitionBy(*both).orderBy("__at"))).filter(F.col("__n") <= cap).drop("__n")
    if key is not None:
        # rows of keys that are taken are passed over, but at most ``most`` keys are
        firsts = given.groupBy(*both, "__key").agg(F.min("__at").alias("__at")).withColumn("__n", F.row_number().over(Window.partitionBy(*both).orderBy("__at"))).filter(F.col("__n") <= cap + most)
        few = few.union(given.join(firsts.select("__at"), "__at", "left_semi").select(few.columns)).dropDuplicates(["__at"])
    few = written(few, "few")
    reasons = F.lit(per_reason) if per_reason else F.lit(None).cast("int")
    patterns = F.when(blank(F.col("pattern_match")) != "", F.lit(per_pattern)) if per_pattern else F.lit(None).cast("int")
    first = filled(few.withColumns({"__cap_a": reasons, "__cap_b": patterns}), *both).orderBy("__at").limit(most)
    first = written(first.select(few.columns).withColumn("__walk", F.lit(1)), "first")
    left = most - first.count()
    taken = first
    if left > 0 and per_pattern:
        # at most ``most`` rows and reasons
        used = first.groupBy(F.col("review_reason").alias("__r")).agg(F.count(F.lit(1)).alias("__used"))
        rest = few.join(first.select("__key").distinct(), "__key", "left_anti").join(used, F.col("review_reason").eqNullSafe(F.col("__r")), "left")
        rest = rest.withColumns({"__cap_a": reasons - F.coalesce("__used", F.lit(0)), "__cap_b": F.lit(1)}).drop("__r", "__used")
        second = filled(rest, "review_reason", "__key").orderBy("__at").limit(left)
        taken = first.unionByName(second.select(few.columns).withColumn("__walk", F.lit(2)))
    placed = taken.orderBy("__walk", "__at").limit(most)
    return placed.withColumn("sample_pos", F.monotonically_increasing_id() + 1).select(*rows.columns, "sample_pos")

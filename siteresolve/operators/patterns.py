"""Evidence patterns: conjunctions of features that tell right outcomes from wrong ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..storage import written
from .balance import ratio

AND = " AND "


def combinations(features, size: int):
    """All sub-arrays of a sorted feature array with 1 to ``size`` (at most 3) elements, as an array of arrays."""
    n = F.size(features)
    at = lambda i: F.get(features, i)
    after = lambda i: F.filter(F.sequence(F.lit(0), n - 1), lambda j: j > i)
    ones = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.array(at(i)))
    found = [ones]
    if size >= 2:
        found.append(F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(after(i), lambda j: F.array(at(i), at(j))))))
    if size >= 3:
        found.append(F.flatten(F.flatten(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.transform(after(i), lambda j: F.transform(after(j), lambda k: F.array(at(i), at(j), at(k))))))))
    return F.when(n > 0, F.concat(*found)).otherwise(F.array().cast("array<array<string>>"))


def mine(rows: DataFrame, size: int = 2, least_support: int = 1, durable_only: bool = False) -> DataFrame:
    """Per pattern: features, support, correct and wrong rows, precision. ``rows``: features (array), correct (boolean).

    Equal feature sets are counted once before anything is combined, so what is exploded grows with distinct sets, not rows. With ``durable_only`` a feature that fewer than
    ``least_support`` correct rows have can't be part of a durable pattern and goes first.
    """
    sets = rows.select(F.array_sort(F.array_distinct("features")).alias("features"), F.col("correct").cast("long").alias("c"))
    sets = sets.groupBy("features").agg(F.count(F.lit(1)).alias("n"), F.sum("c").alias("c"))
    if durable_only:
        frequent = sets.select(F.explode("features").alias("f"), "c").groupBy("f").agg(F.sum("c").alias("c")).filter(F.col("c") >= least_support).select("f")
        kept = sets.select("features", F.explode("features").alias("f")).join(frequent, "f", "left_semi").groupBy("features").agg(F.array_sort(F.collect_list("f")).alias("kept"))
        sets = sets.join(kept, "features").groupBy(F.col("kept").alias("features")).agg(F.sum("n").alias("n"), F.sum("c").alias("c"))
    each = sets.select(F.explode(combinations(F.col("features"), size)).alias("features"), "n", "c")
    found = each.groupBy("features").agg(F.sum("n").alias("support_rows"), F.sum("c").alias("correct_rows")).filter(F.col("support_rows") >= least_support)
    found = found.withColumn("wrong_rows", F.col("support_rows") - F.col("correct_rows"))
    return found.withColumns({"pattern": F.array_join("features", AND), "precision": ratio(F.col("correct_rows"), F.col("support_rows"))})


def safe(patterns: DataFrame, least_support: int) -> DataFrame:
    """Patterns never wrong, with enough support."""
    return patterns.filter((F.col("wrong_rows") == 0) & (F.col("support_rows") >= least_support))


def minimal(patterns: DataFrame) -> DataFrame:
    """Patterns of which no proper part is a pattern too: each pattern's proper parts are listed and looked up, an equi-join."""
    parts = patterns.select("pattern", F.explode(F.filter(combinations(F.col("features"), 2), lambda s: F.size(s) < F.size(F.col("features")))).alias("s")).select("pattern", F.array_join("s", AND).alias("part"))
    covered = parts.join(patterns.select(F.col("pattern").alias("part")), "part", "left_semi").select("pattern").distinct()
    return patterns.join(covered, "pattern", "left_anti")


def canonical(features):
    """A feature array as a set: no nulls, no repeats, in order."""
    return F.array_sort(F.array_distinct(F.array_compact(features)))


BROADCAST_BYTES = 8 << 20


def _placed(df: DataFrame, name: str):
    """``df`` written down, and how a join is to take it or a part of it: as a broadcast where what was written is small, else by shuffles on both sides.

    Left to itself Spark goes by the size of compressed files and by columns' usual widths, which for feature arrays is far too little: it would send all sets or rows to the driver.
    """
    table = written(df, name)
    held = [F.size(c) * 16 + F.octet_length(F.array_join(c, "")) if kind == "array<string>" else F.octet_length(F.col(c).cast("string")) for c, kind in df.dtypes]
    size = table.agg(F.sum(sum((F.coalesce(x, F.lit(0)) for x in held), F.lit(64)).cast("long"))).first()[0] or 0
    return table, F.broadcast if size <= BROADCAST_BYTES else lambda x: x.hint("merge")


def contained(sets: DataFrame, patterns: DataFrame, keep: list[str]) -> DataFrame:
    """(features, *keep) for each of the distinct ``sets`` (column features, canonical) and each pattern all of whose features it has.

    A pattern is filed under the one of its features that the fewest sets have, so a set meets only the patterns filed under its own features, and a feature that nearly all sets
    have holds only patterns made of such features. What meets is then checked in full. Patterns without features, or with one that no set has, match nothing. Sets are never
    broadcast; patterns are where they are small, and sets stay where they are then.
    """
    named, side = _placed(patterns.select(*keep, canonical("features").alias("wanted")).filter(F.size("wanted") > 0), "patterns")
    frequency = sets.select(F.explode("features").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    parts = side(named.select("wanted").distinct().select("wanted", F.explode("wanted").alias("feature"))).join(frequency, "feature")
    filed = parts.groupBy("wanted").agg(F.min_by("feature", F.struct("n", "feature")).alias("anchor"), F.count(F.lit(1)).alias("known")).filter(F.col("known") == F.size("wanted"))
    met = sets.select("features", F.explode("features").alias("anchor")).join(side(filed.select("wanted", "anchor")), "anchor")
    return met.filter(F.size(F.array_except("wanted", "features")) == 0).select("features", "wanted").join(side(named), "wanted").drop("wanted")


def matches(rows: DataFrame, patterns: DataFrame, key: str, first_only: bool = True, order: str = "pattern_pos") -> DataFrame:
    """(key, pattern) of each row for patterns all of whose features it has; the first by ``order`` only, by default.

    Equal feature sets are matched once (``contained``); rows only look their set up. Rows without a match give none.
    """
    rows = rows.select(key, canonical("features").alias("features")).filter(F.size("features") > 0)
    found = contained(rows.select("features").distinct(), patterns, ["pattern", order])
    if first_only:
        found = found.groupBy("features").agg(F.min_by("pattern", F.struct(order, "pattern")).alias("pattern"))
    found, side = _placed(found.select("features", "pattern"), "found")
    return rows.join(side(found), "features").select(key, "pattern")


def release_simulation(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """Per pattern: rows it would release, how many are right and wrong, and the precision. ``rows``: features, correct; counted by feature set before anything is matched."""
    sets = rows.groupBy(canonical("features").alias("features")).agg(F.count(F.lit(1)).alias("n"), F.count_if("correct").alias("c"))
    found = contained(sets.select("features"), patterns, ["pattern"]).join(sets, "features")
    one = found.groupBy("pattern").agg(F.sum("n").alias("released_rows"), F.sum("c").alias("correct_released"))
    return one.withColumns({"wrong_released": F.col("released_rows") - F.col("correct_released"), "release_precision": ratio(F.col("correct_released"), F.col("released_rows"))})


MOST_PATTERNS = 1_000_000


def actionable_set(rows: DataFrame, patterns: DataFrame, most_wrong: int = 0, most_patterns: int = MOST_PATTERNS) -> DataFrame:
    """Greedy cover: patterns with the fewest wrong and most right rows first, each kept if it adds right rows and all wrong ones stay within ``most_wrong``.

    ``rows``: features, correct; ``patterns``: pattern, features, of which ``most_patterns`` may match (else ValueError: what follows sorts a row a pattern in one task). Gives pattern,
    place, new_correct, wrong_so_far.

    The order is fixed beforehand, so as long as no pattern is refused for its wrong rows, a pattern is kept exactly if it is the first of some set with right rows: one
    aggregation. Then the first pattern at which the wrong rows get too many is refused, and with it all later ones that would get too many beside the wrong rows kept so far
    (those never get fewer); only sets that lost their first pattern look for the next. Each round but the last refuses its first one for rows that the round before did not
    have, so there are at most ``most_wrong`` + 2 rounds; the driver sees a few numbers of each.
    """
    spark = rows.sparkSession
    sets = rows.groupBy(canonical("features").alias("features")).agg(F.count_if("correct").alias("right"), F.count_if(~F.col("correct")).alias("wrong"))
    sets = written(sets.withColumn("set", F.monotonically_increasing_id()), "sets")
    hits = written(contained(sets.select("features"), patterns, ["pattern"]).join(sets, "features").select("pattern", "set", "right", "wrong"), "hits")
    sizes = patterns.select("pattern", F.size(canonical("features")).alias("size")).distinct()
    totals = hits.groupBy("pattern").agg(F.sum("right").alias("right"), F.sum("wrong").alias("wrong")).join(sizes, "pattern")
    n = totals.count()
    if n > most_patterns:
        raise ValueError(f"{n} patterns match, more than {most_patterns}")
    ordered = totals.orderBy("wrong", F.desc("right"), "size", "pattern").coalesce(1).select("pattern", F.monotonically_increasing_id().alias("order"))
    ordered = written(ordered, "order")
    hits = written(hits.join(ordered, "pattern").select("order", "set", "right", "wrong"), "gains")
    refused = spark.createDataFrame([], "order long")
    while True:
        alive = hits.join(refused, "order", "left_anti")
        picked = alive.filter("right > 0").groupBy("set").agg(F.min("order").alias("order"), F.first("right").alias("right")).groupBy("order").agg(F.sum("right").alias("new_correct"))
        picked = written(picked, "picked")
        added = alive.filter("wrong > 0").join(picked, "order", "left_semi").groupBy("set").agg(F.min("order").alias("order"), F.first("wrong").alias("wrong"))
        added = written(added, "wrongs")
        by_order = picked.join(added.groupBy("order").agg(F.sum("wrong").alias("wrong")), "order", "left")
        kept = by_order.withColumn("wrong_so_far", F.sum(F.coalesce("wrong", F.lit(0))).over(Window.orderBy("order")))
        broken = kept.filter(F.col("wrong_so_far") > most_wrong).agg(F.min("order")).first()[0]
        if broken is None:
            break
        before = added.filter(F.col("order") < broken)
        room = most_wrong - (before.agg(F.sum("wrong")).first()[0] or 0)
        more = hits.filter((F.col("order") >= broken) & (F.col("wrong") > 0)).join(before.select("set"), "set", "left_anti").groupBy("order").agg(F.sum("wrong").alias("wrong")).filter(F.col("wrong") > room)
        refused = written(refused.union(more.select("order")).distinct(), "refused")
    out = kept.join(ordered, "order").withColumn("place", F.row_number().over(Window.orderBy("order")).cast("long"))
    return out.select("pattern", "place", "new_correct", "wrong_so_far")

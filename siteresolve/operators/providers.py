"""Directory rows to one entity per provider."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import blank, compact

# What the description line under a table's header holds.
DESCRIPTION_MARKERS = ["Amazon SPN 服务商唯一 ID；主表关联键之一", "服务商名称"]


def valid_rows(raw: DataFrame, id_col: str = "provider_id", name_col: str = "provider_name") -> DataFrame:
    """Rows with an id that aren't a description line."""
    own, name = compact(F.col(id_col)), compact(F.col(name_col))
    return raw.filter((own != "") & ~own.isin(DESCRIPTION_MARKERS) & ~name.isin(DESCRIPTION_MARKERS))


def _ordered_distinct(rows: DataFrame, key: str, value: str, pos: str) -> DataFrame:
    """Per key the distinct non-blank values, by first position. Repeats go before anything is collected."""
    firsts = rows.filter(F.trim(blank(F.col(value))) != "").groupBy(key, value).agg(F.min(pos).alias("__at"))
    listed = F.array_sort(F.collect_list(F.struct("__at", value)))
    return firsts.groupBy(key).agg(F.transform(listed, lambda x: x[value]).alias(value))


def merge_providers(raw: DataFrame, lists: dict[str, str], firsts: dict[str, str], key: str = "provider_id", pos: str = "pos") -> DataFrame:
    """One row per provider. ``lists``: output list by source column, ordered and distinct. ``firsts``: output scalar by source column, the first non-blank one.

    ``source_rows`` counts the merged rows. Scalars and the count take one aggregation; each list takes one over its distinct values, all partitioned by the key.
    """
    first: list[Column] = [F.min_by(F.col(c), F.when(F.trim(blank(F.col(c))) != "", F.col(pos))).alias(out) for c, out in firsts.items()]
    merged = raw.groupBy(key).agg(*[F.coalesce(c, F.lit("")).alias(out) for c, out in zip(first, firsts.values())], F.count(F.lit(1)).alias("source_rows"))
    for column, out in lists.items():
        listed = _ordered_distinct(raw, key, column, pos).withColumnRenamed(column, out)
        merged = merged.join(listed, key, "left").withColumn(out, F.coalesce(out, F.array().cast("array<string>")))
    return merged


def dedupe_report(raw: DataFrame, key: str = "provider_id") -> DataFrame:
    """One row: raw, valid and skipped rows, providers, repeated keys, extra rows and the most rows of a key."""
    counts = valid_rows(raw).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("valid_rows"),
        F.count(F.lit(1)).alias("provider_rows"),
        F.count_if(F.col("n") > 1).alias("duplicate_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"),
        F.coalesce(F.max("n"), F.lit(0)).alias("max_rows_per_key"),
    )
    return raw.agg(F.count(F.lit(1)).alias("raw_rows")).crossJoin(totals).withColumn("skipped_rows", F.col("raw_rows") - F.col("valid_rows"))


def most_repeated(raw: DataFrame, key: str = "provider_id", top: int = 25) -> DataFrame:
    """The ``top`` keys with the most rows (a report's list)."""
    return valid_rows(raw).groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy(F.desc("n"), key).limit(top)


def entity_key(id_col: str = "provider_id", name_col: str = "provider_name") -> Column:
    """id:<id>, or name:<lower-cased name> where the id is blank; blank if both are."""
    own, name = F.trim(blank(F.col(id_col))), F.lower(F.trim(blank(F.col(name_col))))
    return F.when(own != "", F.concat(F.lit("id:"), own)).when(name != "", F.concat(F.lit("name:"), name)).otherwise("")


def last_of(rows: DataFrame, key: Column, pos: str = "pos") -> DataFrame:
    """The last row per non-blank key: one aggregation, no sort."""
    packed = F.struct(*[F.col(c) for c in rows.columns])
    return rows.withColumn("__key", key).filter("__key <> ''").groupBy("__key").agg(F.max_by(packed, pos).alias("__row"))


def lookup(rows: DataFrame, table: DataFrame, pos: str = "pos", id_col: str = "provider_id", name_col: str = "provider_name") -> DataFrame:
    """``rows`` with struct ``found``: the table's last row with the id, else the last with the same name in any case. Two equi-joins, never one with OR.

    Rows without an id or name carry a key of their own that nothing has, so they don't meet in one task.
    """
    own, name = F.trim(blank(F.col(id_col))), F.lower(F.trim(blank(F.col(name_col))))
    by_id = last_of(table, own, pos).select(F.col("__key").alias("__id"), F.col("__row").alias("__by_id"))
    by_name = last_of(table, name, pos).select(F.col("__key").alias("__name"), F.col("__row").alias("__by_name"))
    alone = F.concat(F.lit("\u0000"), F.xxhash64(*[F.col(c).cast("string") for c, kind in rows.dtypes if "<" not in kind]).cast("string"))
    joined = rows.withColumn("__i", F.when(own != "", own).otherwise(alone)).withColumn("__n", F.when(name != "", name).otherwise(alone))
    joined = joined.join(by_id, F.col("__i") == F.col("__id"), "left").join(by_name, F.col("__n") == F.col("__name"), "left")
    return joined.withColumn("found", F.coalesce("__by_id", "__by_name")).drop("__i", "__n", "__id", "__name", "__by_id", "__by_name")


def enrich_links(rows: DataFrame, providers: DataFrame, pos: str = "pos") -> DataFrame:
    """``rows`` with provider_detail_url and listing_logo_url of their provider (by id, else by name), their own where that has none; blank where neither has."""
    found = lookup(rows, providers, pos)
    own = lambda c: blank(F.col(c)) if c in rows.columns else F.lit("")
    given = lambda c: blank(F.col(f"found.{c}")) if c in providers.columns else F.lit("")
    pick = lambda *cs: F.trim(F.coalesce(*[F.when(c != "", c) for c in cs], F.lit("")))
    links = {"provider_detail_url": pick(given("detail_url"), own("provider_detail_url"), own("detail_url")), "listing_logo_url": pick(given("listing_logo_url"), own("listing_logo_url"))}
    return found.withColumns(links).drop("found")


def link_counts(enriched: DataFrame) -> DataFrame:
    """One row: input_rows, provider_detail_url_rows, missing_provider_detail_url_rows, listing_logo_rows."""
    has = F.col("provider_detail_url") != ""
    return enriched.agg(F.count(F.lit(1)).alias("input_rows"), F.count_if(has).alias("provider_detail_url_rows"), F.count_if(~has).alias("missing_provider_detail_url_rows"), F.count_if(F.col("listing_logo_url") != "").alias("listing_logo_rows"))


def combine_by_key(sets: list[DataFrame], pos: str = "pos") -> DataFrame:
    """One row per entity key over several sets of decisions; later sets, and later rows in a set, win."""
    parts = [df.withColumn("__set", F.lit(k)) for k, df in enumerate(sets)]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    last = rows.withColumn("__key", entity_key()).filter("__key <> ''").groupBy("__key").agg(F.max_by(F.struct(*rows.columns), F.struct("__set", pos)).alias("r"))
    return last.select("r.*").drop("__set")


def resume(rows: DataFrame, done: DataFrame, key: str = "provider_id") -> DataFrame:
    """Rows whose entity isn't in the output yet."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def page_of(rows: DataFrame, offset: int, limit: int, pos: str = "pos") -> DataFrame:
    return rows.orderBy(pos).offset(offset).limit(limit)


def cut_per_key(rows: DataFrame, key: list[str], order: list[Column], n: int) -> DataFrame:
    return rows.withColumn("__n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("__n") <= n).drop("__n")

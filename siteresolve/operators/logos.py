"""Logos by their 64-bit average hashes, packed into longs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 64
MATCH, NEAR = 0.88, 0.78
MATCH_POINTS, NEAR_POINTS = 18, 8
PER_PAGE = 6
BLOCKS = 4


def packed(bits: Column) -> Column:
    """A hash of 64 characters 0 and 1 as a long; null for any other text."""
    return F.when(bits.rlike("^[01]{64}$"), F.conv(bits, 2, -10).cast("long"))


def similarity(a: Column, b: Column) -> Column:
    """Share of equal bits; null if one is null."""
    return 1.0 - F.bit_count(a.bitwiseXOR(b)) / float(BITS)


def best_logos(listed: DataFrame, pages: DataFrame, hashes: DataFrame, per_page: int = PER_PAGE) -> DataFrame:
    """Per row of ``listed`` (provider_id, pos, listing_logo_url, url): matched, near, score, points, reason and logo_url, the best of its page's first logos.

    ``pages``: url, logos (addresses in order, repeats count once); ``hashes``: logo_url, hash (packed). Equi-joins on addresses; of equal logos the first counts. Rows without a
    listed logo, a page or logos score 0.
    """
    keys = ["provider_id", "pos"]
    own = hashes.select(F.col("logo_url").alias("listing_logo_url"), F.col("hash").alias("own"))
    rows = listed.join(pages.select("url", F.slice(F.array_distinct(F.filter("logos", lambda x: x != "")), 1, per_page).alias("logos")), "url", "left").join(own, "listing_logo_url", "left")
    tried = rows.select(*keys, "own", F.posexplode("logos").alias("k", "logo_url")).filter(F.col("own").isNotNull()).join(hashes.select("logo_url", "hash"), "logo_url")
    alike = similarity(F.col("own"), F.col("hash"))
    best = tried.filter(alike > 0).groupBy(*keys).agg(F.min_by(F.struct(alike.alias("share"), "logo_url"), F.struct((-alike).alias("s"), "k")).alias("best"))
    out = rows.join(best, keys, "left")
    share = F.coalesce("best.share", F.lit(0.0))
    given = (F.coalesce("listing_logo_url", F.lit("")) != "") & F.col("logos").isNotNull()
    reason = (
        F.when(~given, "missing_listing_logo_or_html")
        .when(F.size("logos") == 0, "no_candidate_logo_urls")
        .when(F.col("own").isNull(), "listing_logo_unavailable")
        .when(F.col("best").isNull(), "no_logo_match")
        .when(share >= MATCH, "logo_visual_match")
        .otherwise("logo_visual_near_match")
    )
    matched = share >= MATCH
    # the score as delivered is rounded, and so is what the lower threshold looks at
    near = ~matched & (F.round(share, 3) >= NEAR)
    points = F.when(matched, MATCH_POINTS).when(near, NEAR_POINTS).otherwise(0)
    return out.select(*keys, matched.alias("matched"), near.alias("near"), F.round(share, 3).alias("score"), points.alias("points"), reason.alias("reason"), F.col("best.logo_url").alias("logo_url"))


def _block(hash_: Column, k) -> Column:
    width = BITS // BLOCKS
    return F.shiftrightunsigned(hash_, k * width).bitwiseAND((1 << width) - 1)


def near_logos(queries: DataFrame, table: DataFrame, least: float = MATCH) -> DataFrame:
    """(query_id, id, share) for each row of ``table`` (id, hash) that shares ``least`` or more of a query's (query_id, hash) bits.

    Hashes within d bits agree in one of BLOCKS blocks up to d // BLOCKS bits, so a query looks each block up under all values that near: with MATCH (d = 7) the value itself and its 16
    neighbours of one bit. A table's row stands once under each of its blocks. Equal hashes of the table meet a query as one row and are named afterwards, so copies of a logo
    cost one comparison. Works down to 57 of 64 bits (d // BLOCKS of one); less raises ValueError.
    """
    most = int(BITS * (1 - least) + 1e-9)
    if most // BLOCKS > 1:
        raise ValueError("hashes so far apart need more blocks")
    width = BITS // BLOCKS
    stored = table.select("hash").filter("hash IS NOT NULL").distinct().select("hash", F.posexplode(F.array(*[_block(F.col("hash"), k) for k in range(BLOCKS)])).alias("block", "value"))
    flips = F.array(*[F.lit(0)] + [F.lit(1 << b) for b in range(width)] if most >= BLOCKS else [F.lit(0)])
    asked = queries.select(F.col("hash").alias("asked")).filter("asked IS NOT NULL").distinct()
    probes = asked.select("asked", F.posexplode(F.array(*[_block(F.col("asked"), k) for k in range(BLOCKS)])).alias("block", "v")).select("asked", "block", F.explode(flips).alias("f"), "v")
    probes = probes.select("asked", "block", F.col("v").bitwiseXOR(F.col("f").cast("long")).alias("value"))
    met = probes.join(stored, ["block", "value"]).filter(F.bit_count(F.col("asked").bitwiseXOR(F.col("hash"))) <= most).select("asked", "hash").distinct()
    named = met.join(queries.select("query_id", F.col("hash").alias("asked")), "asked").join(table.select("id", "hash"), "hash")
    return named.select("query_id", "id", similarity(F.col("asked"), F.col("hash")).alias("share"))

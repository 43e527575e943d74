"""Exact dedup by a tree merge of sorted digest runs, in DataFrame operations only.

Rows are dealt evenly over leaf runs, one per task. A run is a partition sorted by digest, with one
entry per distinct text: the digest, the identifier to keep and the number of rows. The runs are
exchanged in rounds, as in a binomial (recursive-halving) exchange with ``fan_in`` partners a round:
in round r an entry moves from its run to the partner run whose r-th digit equals the r-th digit of
the digest's hash. Each run receives ``fan_in`` sorted pieces and merges them in digest order; of
equal entries the one with the smallest (or largest) identifier is retained, with the sum of their
rows. After the last round every digest has exactly one entry, and the entries are spread evenly
over all runs - no round brings everything together in one place.

What is retained then goes back down the same tree: in each round an entry of several rows is told
to the pieces that it was merged from, and in the end to the rows of each leaf. So a text with a
third of all rows is one entry per leaf on the way up, ``fan_in`` entries a merge on the way down,
and its rows meet their entry leaf by leaf, never in one task. An entry is identified by SHA-256
*and* a second, independent 64-bit hash *and* the byte length, so what is retained at each level is
verified.

Nulls and repeats: a null text counts as empty; rows with equal ids and equal texts are separate
rows of one group and share the outcome; a null id never wins over a non-null one; a group with
only null ids keeps them all. Extra columns pass through. An empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, partitions, text_or_empty, utf8_bytes

KEY = ["__sha", "__check", "__bytes"]
ENTRY = ["__run", *KEY, "__keep", "__n"]


def tree(n: int, fan_in: int) -> tuple[int, int]:
    """Rounds and partners a round, ``fan_in`` or fewer, whose runs are about one for each of ``n`` tasks."""
    rounds = max(1, math.ceil(math.log(n) / math.log(fan_in) - 1e-9)) if n > 1 else 1
    return rounds, max(2, math.ceil(n ** (1 / rounds) - 1e-9))


def digests(docs: DataFrame, runs: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: __id, KEY, and the leaf run that it is dealt to."""
    text = text_or_empty(text_col)
    return docs.select(
        F.col(id_col).alias("__id"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("__sha"),
        F.xxhash64(text).alias("__check"),
        utf8_bytes(text).alias("__bytes"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(runs)).cast("int").alias("__run"),
    )


def merged(pieces: DataFrame, runs: int, keep: str = "min") -> DataFrame:
    """Each run's pieces merged in digest order: one entry per digest and run."""
    order = F.col("__keep").asc_nulls_last() if keep == "min" else F.col("__keep").desc_nulls_last()
    equal = Window.partitionBy("__run", *KEY).orderBy(order)
    every = equal.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = pieces.repartitionById(runs, F.col("__run")).sortWithinPartitions("__run", *KEY, order)
    return dealt.withColumn("__n", F.sum("__n").over(every)).withColumn("__nth", F.row_number().over(equal)).filter("__nth = 1").select(ENTRY)


def moved(entries: DataFrame, r: int, fan_in: int) -> DataFrame:
    """Entries with the run that each goes to in round r, and __from, the run it comes from."""
    step = fan_in**r
    wanted = F.pmod(F.xxhash64("__check", F.lit(r)), F.lit(fan_in)).cast("int")
    own = F.pmod((F.col("__run") / F.lit(step)).cast("int"), F.lit(fan_in))
    return entries.withColumn("__from", F.col("__run")).withColumn("__run", F.col("__run") + (wanted - own) * F.lit(step))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "min", fan_in: int = 8) -> DataFrame:
    """Per row of ``docs``: its id, keep_id, group_size, kept, text_sha256."""
    rounds, fan_in = tree(partitions(docs.sparkSession), fan_in)
    runs = fan_in**rounds
    rows = durable(digests(docs, runs, id_col, text_col), "digests")
    levels = [durable(merged(rows.select("__run", *KEY, F.col("__id").alias("__keep"), F.lit(1).cast("long").alias("__n")), runs, keep), "runs")]
    for r in range(rounds):
        levels.append(durable(merged(moved(levels[-1], r, fan_in).select(ENTRY), runs, keep), "runs"))
    told = levels[-1].filter("__n > 1").select(ENTRY)
    for r in reversed(range(rounds)):
        pieces = moved(levels[r], r, fan_in).select("__from", "__run", *KEY)
        told = pieces.join(told, ["__run", *KEY]).select(F.col("__from").alias("__run"), *KEY, "__keep", "__n")
    joined = rows.join(told, ["__run", *KEY], "left")
    alone = F.col("__n").isNull()
    keep_id = F.when(alone, F.col("__id")).otherwise(F.col("__keep"))
    return joined.select(
        F.col("__id").alias(id_col),
        keep_id.alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("__n")).cast("long").alias("group_size"),
        F.col("__id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex("__sha")).alias("text_sha256"),
    )


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER w AS keep_id,
       count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""

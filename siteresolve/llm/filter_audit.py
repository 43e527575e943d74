"""Filter interaction audit: what each of five filters removes in every order of application.

The documents become a sparse document-term matrix. Each task turns its texts into CSR shards of
about SHARD_BYTES of whole texts over a dictionary of its own (``local_shards``); the words of all
shards make one global dictionary (``numbered``), and each shard's indices are rewritten to its ids (``matrix``). A row's sum is
its number of words and its stored entries are its distinct words: these decide filters A and B.
The remaining flags are attached to the rows, then all that is left is aggregation.

A document fails a filter when: A, it has under 100 words; B, 100 * distinct words < 80 * words;
C, 100 * capitals A-Z > 10 * code points; D, it holds one of ``#$%&*|``; E, its text is identical
to that of a document with a smaller id. Words are maximal runs of anything but 0x20 and 0x09-0x0D.

E needs no join back to the rows: of each text's rows, counted by part and flags, all but those that
hold the smallest id fail. So a text with a third of all rows is a few counted rows per task before
anything is shuffled. Texts are told apart by SHA-256 and length. Orders and steps unfold only after
the rows are counted by part and the set of filters they fail, at most 32 rows a part.

Nulls and repeats: a null text is empty (it has no words, so it fails A, never B, C or D); a null part
is the empty string; a null id is neither smaller nor larger than others, so its row never fails E,
and it has no label. Rows that share an id are rows of their own; each takes the id's label, and
of several labels of an id any 1 counts. Texts of any length are taken whole, a long one as a shard
of its own. Extra columns of either table are ignored, whatever their names. An empty table has no
parts and gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, partitions
from .words import text_parts

FILTERS = "ABCDE"
SHARD_BYTES = 4 << 20
ENTRIES = 1 << 17
#: Buckets of words for each shuffle partition.
BUCKETS = 4
#: A row group of a written shard table holds a few shards, so that a reader's batch does too.
SHARD_FILES = {"compression": "zstd", "parquet.block.size": 8 << 20}
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#$%&*|")] = True


def _packed(starts: np.ndarray, places: np.ndarray, counts: np.ndarray) -> bytes:
    """A local shard's CSR arrays, small on disk and in shuffles: differences of places, bytes of equal weight side by side."""
    gaps = np.diff(places, prepend=0)
    values = np.concatenate([np.diff(starts), gaps, counts]).astype("<i4")
    return len(starts).to_bytes(8, "little") + zstandard.ZstdCompressor(level=1).compress(values.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(body: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = int.from_bytes(body[:8], "little") - 1
    values = np.ascontiguousarray(np.frombuffer(zstandard.ZstdDecompressor().decompress(body[8:]), np.uint8).reshape(4, -1).T).view("<i4").ravel().astype(np.int64)
    starts = np.concatenate([[0], np.cumsum(values[:n])])
    end = n + starts[-1]
    return starts, np.cumsum(values[n:end]), values[end:]


def _lists(values: pa.Array | np.ndarray, kind: pa.DataType) -> pa.Array:
    """A column of one row: the list of all ``values``."""
    values = pa.array(values, kind) if isinstance(values, np.ndarray) else values.cast(kind)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def local_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """A row per shard: per document its id, part, digest, fails (of C and D) and where its entries start; per stored entry the place of its word in ``words`` (in order) and its count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        for batch in batches:
            for a, b, raw, offs in text_parts(batch.column(1), shard_bytes):
                whole = raw.tobytes()
                texts = [whole[x:y] for x, y in zip(offs, offs[1:])]
                split = [x.split() for x in texts]
                coded = pa.array([w for x in split for w in x], pa.binary()).dictionary_encode()
                order = pc.array_sort_indices(coded.dictionary)
                vocabulary, rank = coded.dictionary.take(order).cast(pa.string()), np.argsort(order.to_numpy())
                rows = np.repeat(np.arange(b - a), [len(x) for x in split])
                entries, counts = np.unique(rows * max(1, len(vocabulary)) + rank[coded.indices.to_numpy()], return_counts=True)
                starts = np.searchsorted(entries, np.arange(b - a + 1) * max(1, len(vocabulary)))
                capitals, symbols, points = (np.diff(np.concatenate([[0], np.cumsum(x)])[offs]) for x in ((raw >= 65) & (raw <= 90), _SYMBOL[raw], (raw & 0xC0) != 0x80))
                fails = [("C" if 100 * c > 10 * p else "") + ("D" if s else "") for c, s, p in zip(capitals.tolist(), symbols.tolist(), points.tolist())]
                digests = [hashlib.sha256(x).digest() + len(x).to_bytes(8, "big") for x in texts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int64()),
                        _lists(batch.column(0).slice(a, b - a), batch.column(0).type),
                        _lists(batch.column(2).slice(a, b - a).fill_null(""), pa.string()),
                        _lists(pa.array(digests, pa.binary()), pa.binary()),
                        _lists(pa.array(fails, pa.string()), pa.string()),
                        pa.array([_packed(starts, entries % max(1, len(vocabulary)), counts)], pa.binary()),
                        _lists(vocabulary, pa.string()),
                    ],
                    ["shard", "ids", "parts", "digests", "fails", "entries", "words"],
                )
                shard += 1

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(part_col).cast("string").alias("part")).mapInArrow(
        run, f"shard long, ids array<{kind}>, parts array<string>, digests array<binary>, fails array<string>, entries binary, words array<string>"
    )


def numbered(words: DataFrame) -> DataFrame:
    """``words`` (column word, a row per shard and word) with word_id, the global dictionary's number of the word.

    Words are dealt over buckets by hash and numbered in order inside each; bucket b of n has the ids b, b + n,
    b + 2n, and so on. So equal words meet once, where they get their id, and nothing goes back to be looked up.
    """
    n = BUCKETS * partitions(words.sparkSession)
    bucket = F.pmod(F.xxhash64("word"), F.lit(n))
    place = F.dense_rank().over(Window.partitionBy("bucket").orderBy("word"))
    return words.withColumn("bucket", bucket).withColumn("word_id", (place.cast("long") - 1) * n + F.col("bucket")).drop("bucket")


def matrix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The document-term matrix in CSR shards of about ENTRIES entries: ids, parts, digests, fails, indptr, indices (global word ids, ascending in each row), data."""
    local = durable(local_shards(docs, id_col, text_col, part_col, shard_bytes), "shards", **SHARD_FILES)
    words = local.select("shard", F.posexplode("words").alias("at", "word"))
    known = numbered(words).groupBy("shard").agg(F.collect_list("at").alias("ats"), F.collect_list("word_id").alias("word_ids"))

    def rewritten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                starts, places, counts = _unpacked(row.column("entries")[0].as_py())
                ids = np.zeros(len(row.column("ats").flatten()), np.int64)
                ids[row.column("ats").flatten().to_numpy()] = row.column("word_ids").flatten().to_numpy()
                ids = ids[places]
                order = np.lexsort([ids, np.repeat(np.arange(len(starts) - 1), np.diff(starts))])
                ids, counts, a = ids[order], counts[order], 0
                while a < len(starts) - 1:  # parts of whole rows
                    b = max(a + 1, int(np.searchsorted(starts, starts[a] + ENTRIES, "right")) - 1)
                    inside = slice(starts[a], starts[b])
                    yield pa.RecordBatch.from_arrays(
                        [*(_lists(row.column(c).flatten().slice(a, b - a), row.column(c).type.value_type) for c in kept), _lists(starts[a : b + 1] - starts[a], pa.int64()), _lists(ids[inside], pa.int64()), _lists(counts[inside], pa.int32())],
                        [*kept, "indptr", "indices", "data"],
                    )
                    a = b

    kept = ["ids", "parts", "digests", "fails"]
    kinds = ", ".join(f"{c} {local.schema[c].dataType.simpleString()}" for c in kept)
    return local.drop("words").join(known, "shard", "left").mapInArrow(rewritten, f"{kinds}, indptr array<long>, indices array<long>, data array<int>")


def flags(shards: DataFrame) -> DataFrame:
    """Per document: id, part, digest, n_words (the row's sum), n_distinct (its stored entries), and fails, the letters of the filters other than E that it fails."""

    def row(i):
        at = lambda c: F.get(c, i)
        n = (F.get("indptr", i + 1) - at("indptr")).cast("int")
        total = F.aggregate(F.slice("data", (at("indptr") + 1).cast("int"), n), F.lit(0).cast("long"), lambda s, x: s + x)
        return F.struct(at("ids").alias("id"), at("parts").alias("part"), at("digests").alias("digest"), at("fails").alias("others"), total.alias("n_words"), n.cast("long").alias("n_distinct"))

    rows = shards.select(F.inline(F.transform(F.sequence(F.lit(0), F.size("ids") - 1), row)))
    few, alike = F.col("n_words") < 100, 100 * F.col("n_distinct") < 80 * F.col("n_words")
    fails = F.concat(F.when(few, "A").otherwise(""), F.when(alike, "B").otherwise(""), F.col("others"))
    return rows.select("id", "part", "digest", "n_words", "n_distinct", fails.alias("fails"))


def counted(rows: DataFrame) -> DataFrame:
    """part, fails (E among them now), n, n_good, n_toxic from rows of id, part, digest, fails, good, toxic."""
    group = ["digest", "part", "fails", "good", "toxic"]
    by_id = rows.groupBy(*group, "id").agg(F.count(F.lit(1)).alias("n"))
    known = F.col("id").isNotNull()
    by_text = by_id.groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum(F.when(~known, F.col("n")).otherwise(0)).alias("n_null"), F.min("id").alias("least"), F.min(F.when(known, F.struct("id", "n")))["n"].alias("n_least")
    )
    first = F.col("least") == F.min("least").over(Window.partitionBy("digest"))
    stay = F.struct("fails", F.col("stay").alias("n"))
    fail = F.struct(F.concat("fails", F.lit("E")).alias("fails"), (F.col("n") - F.col("stay")).alias("n"))
    split = by_text.withColumn("stay", F.col("n_null") + F.when(first, F.col("n_least")).otherwise(0))
    both = split.select("part", "good", "toxic", F.inline(F.array(stay, fail)))
    n = F.col("n")
    return both.filter("n > 0").groupBy("part", "fails").agg(F.sum(n).alias("n"), F.sum(n * F.col("good")).alias("n_good"), F.sum(n * F.col("toxic")).alias("n_toxic"))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Per part, order and step: part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    labelled = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = flags(matrix(docs, id_col, text_col, part_col, shard_bytes)).drop("n_words", "n_distinct").join(labelled, "id", "left")
    # written, so that nothing after the join keeps an uneven id from being split
    rows = durable(rows.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("good", "toxic")}), "flags")
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    each = counted(rows).withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    each = each.withColumns({"letter": F.expr("substring(filter_order, step, 1)"), "before": F.expr("substring(filter_order, 1, step - 1)")})
    fails, earlier = F.expr("locate(letter, fails) > 0"), F.expr("translate(before, fails, '') <> before")
    n, removed = F.col("n"), fails & ~earlier

    def total(when, what="n"):
        return F.coalesce(F.sum(F.when(when, F.col(what))), F.lit(0)).cast("long")

    # over all orders a filter comes first among the k that a row fails in 1 of k
    share = F.when(fails, n * F.lit(len(list(permutations(FILTERS)))) / F.length("fails")).cast("long")
    return each.groupBy("part", "filter_order", "step").agg(
        total(~fails & ~earlier).alias("kept"), total(removed).alias("removed"), total(fails & earlier).alias("redundant"), total(F.col("fails") == F.col("letter")).alias("unique_fails"),
        total(removed, "n_good").alias("good_lost"), total(removed, "n_toxic").alias("toxic_lost"), F.coalesce(F.sum(share), F.lit(0)).cast("long").alias("shapley"),
    )


ORACLE = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
lab AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
flagged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CASE WHEN len(w) < 100 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN coalesce(words.doc_id > min(words.doc_id) OVER (PARTITION BY t), false) THEN 'E' ELSE '' END AS fails
  FROM words LEFT JOIN lab ON words.doc_id = lab.doc_id),
masks AS (SELECT part, fails, count(*) AS n, sum(good) AS g, sum(toxic) AS x FROM flagged GROUP BY part, fails),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (SELECT a.c || b.c || d.c || e.c || f.c AS filter_order FROM letters a, letters b, letters d, letters e, letters f
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5),
steps AS (SELECT filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS letter, substr(filter_order, 1, step - 1) AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
each AS (SELECT part, filter_order, step, n, g, x, fails, letter, contains(fails, letter) AS hit, before <> '' AND translate(before, fails, '') <> before AS earlier FROM masks, steps)
SELECT part, filter_order, step,
  CAST(coalesce(sum(n) FILTER (NOT hit AND NOT earlier), 0) AS BIGINT) AS kept, CAST(coalesce(sum(n) FILTER (hit AND NOT earlier), 0) AS BIGINT) AS removed,
  CAST(coalesce(sum(n) FILTER (hit AND earlier), 0) AS BIGINT) AS redundant, CAST(coalesce(sum(n) FILTER (fails = letter), 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(sum(g) FILTER (hit AND NOT earlier), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(x) FILTER (hit AND NOT earlier), 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(n * (120 // greatest(length(fails), 1))) FILTER (hit), 0) AS BIGINT) AS shapley
FROM each GROUP BY part, filter_order, step
"""

"""Near-duplicate documents by SuperMinHash, banding, verification on full sets and union-find.

Signatures (SuperMinHash): each element of a set walks through a random permutation of the m
registers; its j-th visit offers j + r to the register it visits, r uniform in [0, 1). A register
keeps the least offer. Offers of step j can't improve a register that is below j, so a set stops
as soon as all its registers are - after one step for large sets. Here all elements of a batch take
a step together.

From signatures to components:

1. Rows with equal sets are one node (the row with the smallest id). BANDS bands of ROWS registers
   give bucket keys; a bucket ties its nodes to its smallest one. Connected, these are candidate
   clusters: every pair that shares a bucket is inside one cluster. A pair at the threshold 0.85
   shares none with probability (1 - 0.85**8)**40 = 3e-6, a pair at the pipeline's 0.8 with
   (1 - 0.8**8)**40 = 6.5e-4 (registers taken as independent).
2. Clusters are verified on full sets of 64-bit shingle hashes. A cluster is cut into blocks of
   about BLOCK nodes by hash, each block one group of a grouped function: all its pairs that
   aren't connected yet are compared. Only verified links connect nodes from here on.
3. Of a cluster with several blocks, up to PIVOTS nodes - the best linked of some blocks - are
   compared with all blocks. This joins what is left of a group of copies, at about its size's cost.
4. Then buckets decide, not clusters: of a bucket whose nodes are in several components, the nodes
   outside its largest component are compared with all its nodes, in parts and blocks of about
   BLOCK. After this every pair that shares a bucket is in one component or has been compared, so
   no link between candidates is lost. Nodes that share no bucket aren't compared here, however
   large the cluster that chains of buckets make of them.

Equal sets are told by their size and two sums of 64-bit hashes of their shingles.

Null texts and texts without words have no shingles and link with nothing. Rows with equal ids are
one node of the graph. A null id is a node of its own: component null, kept. Extra columns don't
take part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, released, size_checked
from .components import UnionFind, components
from .words import mixed, text_parts, window_hashes, word_hashes

BANDS, ROWS = 40, 8
BLOCK = 100
PIVOTS = 16
SALTS = 32
SIGN_BYTES = 1 << 17
_ODD = 0x9E3779B97F4A7C15
_STEP = np.uint64(_ODD)
_NO_STATE = 8192  # elements taken through the steps together


# ---- sets and signatures --------------------------------------------------------------------


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct k-word shingle hashes, sorted within each row, and their number per row. Rows of fewer words: the whole sequence as one."""
    words, counts = word_hashes(raw, offsets, lower=True)
    h, row, _ = window_hashes(words, counts, k)
    if (few := (counts > 0) & (counts < k)).any():
        start = np.cumsum(counts) - counts
        extra = []
        for n in range(1, k):
            at = np.flatnonzero(few & (counts == n))
            x = words[start[at]] if len(at) else np.zeros(0, np.uint64)
            for j in range(1, n):
                x = x * np.uint64(0xD1342543DE82EF95) + words[start[at] + j]
            extra.append((mixed(x + np.uint64(n)), at))
        h, row = np.concatenate([h, *(x for x, _ in extra)]), np.concatenate([row, *(a for _, a in extra)])
    order = np.lexsort((h, row))
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return h[new], np.bincount(row[new], minlength=len(counts))


def _random(h: np.ndarray, step: int) -> np.ndarray:
    return mixed(h + np.uint64(_ODD * (2 * step + 1) % (1 << 64)))


def signatures(h: np.ndarray, counts: np.ndarray, m: int = BANDS * ROWS) -> np.ndarray:
    """SuperMinHash signatures (rows x m) of the sets that ``h`` holds one after another; inf for empty sets."""
    sig = np.full((len(counts), m), np.inf)
    row = np.repeat(np.arange(len(counts)), counts)
    # the n-th portion of _NO_STATE elements of each row: memory for permutations stays bounded for any set
    portion = (np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)) // _NO_STATE
    for p in range(int(portion.max()) + 1 if len(h) else 0):
        own = np.flatnonzero(portion == p)
        _offer(sig, h[own], row[own], m)
    return sig


def _offer(sig: np.ndarray, h: np.ndarray, row: np.ndarray, m: int) -> None:
    place = None
    ids = np.arange(len(h))
    for j in range(m):
        x = _random(h, j)
        r = (x >> np.uint64(11)).astype(np.float64) * 2.0**-53
        k = j + (mixed(x ^ _STEP) % np.uint64(m - j)).astype(np.int64)
        if place is None:
            target = k
        else:
            target = place[ids, k]
        np.minimum.at(sig.reshape(-1), row * m + target, j + r)
        # a set goes on while a register is not below the next step
        on = (sig.max(axis=1) > j + 1)[row]
        if not on.any():
            return
        if place is None:
            place = np.broadcast_to(np.arange(m, dtype=np.int16), (int(on.sum()), m)).copy()
            kept, k_on = np.flatnonzero(on), k[on]
        else:
            kept, k_on = np.flatnonzero(on), k[on]
            place = place[kept] if len(kept) < len(h) else place
        h, row, ids = h[kept], row[kept], np.arange(len(kept))
        # swap places j and k
        at_k = place[ids, k_on].copy()
        place[ids, k_on] = place[:, j]
        place[:, j] = at_k


def band_keys(sig: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    bits = sig.view(np.uint64).reshape(len(sig), bands, rows)
    key = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64) * _STEP), (len(sig), bands)).copy()
    for k in range(rows):
        key = mixed(key * np.uint64(0xD1342543DE82EF95) + bits[:, :, k])
    return key


def signed(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, n, set_a, set_b (hashes of the whole set), bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in released(batches):
            for a, b, raw, offs in text_parts(batch.column(1), SIGN_BYTES):
                h, counts = shingle_sets(raw, offs, k)
                edge = np.append(0, np.cumsum(counts))
                whole = [np.append(np.uint64(0), np.cumsum(mixed(h ^ np.uint64(s)))) for s in (0x1234567, 0x89ABCDE)]
                set_a, set_b = ((w[edge[1:]] - w[edge[:-1]]).view(np.int64) for w in whole)
                keys = band_keys(signatures(h, counts)).view(np.int64)
                some = counts > 0
                lengths = np.where(some, BANDS, 0)
                bands = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)).astype(np.int32)), pa.array(keys[some].reshape(-1)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(counts.astype(np.int64)), pa.array(set_a), pa.array(set_b), bands], ["id", "n", "set_a", "set_b", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, n long, set_a long, set_b long, bands array<long>")


# ---- verification ---------------------------------------------------------------------------


def _sets(texts: pa.ChunkedArray, k: int) -> list[np.ndarray]:
    out: list[np.ndarray] = []
    for _, _, raw, offs in text_parts(texts.combine_chunks() if texts.num_chunks != 1 else texts.chunk(0)):
        h, counts = shingle_sets(raw, offs, k)
        out += np.split(h, np.cumsum(counts)[:-1])
    return out


def similar(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """den * |a and b| >= num * |a or b|, of sorted distinct values."""
    if len(a) > len(b):
        a, b = b, a
    if den * len(a) < num * len(b):
        return False
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return den * both >= num * (len(a) + len(b) - both)


def _within(table: pa.Table, k: int, num: int, den: int) -> pa.Table:
    """Links of one block: node, root, links found (all pairs are counted if the cluster has more blocks)."""
    ids, sets, blocks = table.column("id").to_pylist(), _sets(table.column("text"), k), table.column("blocks")[0].as_py()
    found, degree = UnionFind(), [0] * len(ids)
    order = sorted(range(len(ids)), key=lambda i: len(sets[i]))
    for y in range(len(order)):
        for x in range(y - 1, -1, -1):
            i, j = order[x], order[y]
            if den * len(sets[i]) < num * len(sets[j]):
                break
            if (blocks > 1 or found.find(ids[i]) != found.find(ids[j])) and similar(sets[i], sets[j], num, den):
                found.join(ids[i], ids[j])
                degree[i] += 1
                degree[j] += 1
    return pa.table({"a": pa.array(ids, pa.int64()), "b": pa.array([found.find(x) for x in ids], pa.int64()), "degree": pa.array(degree, pa.int64())})


def _across(table: pa.Table, k: int, num: int, den: int) -> pa.Table:
    """Links between the rows with side 0 and those with side 1 that aren't in one component yet; among the rows with side 0, if there are no others."""
    ids, comps, side = (table.column(c).to_pylist() for c in ("id", "comp", "side"))
    found = UnionFind()
    out = []
    mine, other = [i for i, s in enumerate(side) if s == 0], [i for i, s in enumerate(side) if s == 1]
    if mine and (other or len(set(comps)) > 1):
        sets = _sets(table.column("text"), k)
        for at, j in enumerate(other or mine):
            for i in mine if other else mine[:at]:
                if found.find(comps[i]) != found.find(comps[j]) and similar(sets[i], sets[j], num, den):
                    found.join(comps[i], comps[j])
                    out.append((ids[i], ids[j]))
    return pa.table({"a": pa.array([a for a, _ in out], pa.int64()), "b": pa.array([b for _, b in out], pa.int64())})


def _texts_of(docs: DataFrame, nodes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``nodes`` (id, set_a, ...) with a text each; a small list of nodes is broadcast, a long one joined by shuffle."""
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).filter("id is not null")
    return texts.join(size_checked(nodes, 48), "id")


def near_groups(docs: DataFrame, k: int = 3, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_shingles, component_id (smallest id reachable over links of similarity num/den or more), kept."""
    rows = durable(signed(docs, k, id_col, text_col), "signatures")
    # equal sets, then nodes for each distinct set; rows that share an id are tied by it
    sets = rows.filter("n > 0 and id is not null")
    firsts = sets.groupBy("set_a", "set_b").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"))
    # the copies of one set are told its first row by salted keys, so that a large group meets in SALTS tasks and not in one
    told = firsts.filter("copies > 1").select("set_a", "set_b", "first", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    salted = sets.select("id", "set_a", "set_b", F.pmod(F.xxhash64("id", F.lit(9)), F.lit(SALTS)).cast("int").alias("salt"))
    same = durable(salted.join(told, ["set_a", "set_b", "salt"]).select(F.col("id").alias("a"), F.col("first").alias("b")).filter("a <> b").distinct(), "copies")
    nodes = sets.select("id", "bands").join(same.select(F.col("a").alias("id")), "id", "left_anti")
    buckets = nodes.select("id", F.explode("bands").alias("bucket"))
    least = buckets.groupBy("bucket").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("bucket", "first")
    candidates = components(buckets.join(least, "bucket").select(F.col("id").alias("a"), F.col("first").alias("b")).distinct())
    members = candidates.select(F.col("node").alias("id"), F.col("component").alias("cluster")).union(candidates.select(F.col("component").alias("id"), F.col("component").alias("cluster")).distinct())
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size")).select("cluster", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"))
    placed = members.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int"))
    placed = durable(placed, "clusters")
    links = durable(
        _texts_of(docs, placed, id_col, text_col).groupBy("cluster", "block").applyInArrow(lambda t: _within(t, k, num, den), "a long, b long, degree long"),
        "links",
    )
    large = placed.filter("blocks > 1")
    all_links = links.select("a", "b").filter("a <> b").union(same)
    if large.limit(1).count():
        now = _comps(large, components(links.select("a", "b")))
        slots = now.join(links.select(F.col("a").alias("id"), "degree"), "id").withColumn("slot", F.pmod(F.xxhash64("block"), F.lit(PIVOTS)))
        best = slots.groupBy("cluster", "slot").agg(F.max(F.struct("degree", "id")).alias("p")).select("cluster", F.col("p.id").alias("id"))
        pivots = now.join(best.select("id"), "id", "left_semi")
        more = durable(_compared(docs, now.withColumn("parts", F.lit(1)), pivots.withColumn("part", F.lit(0)), k, num, den, id_col, text_col), "pivots")
        now = _comps(large, components(links.select("a", "b").union(more)))
        left = durable(_compared(docs, *_mixed(nodes, now), k, num, den, id_col, text_col), "bucket-links")
        all_links = all_links.union(more).union(left)
    final = components(all_links)
    out = rows.select("id", "n").join(final.select(F.col("node").alias("id"), "component"), "id", "left")
    component = F.coalesce("component", "id")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))


def _comps(large: DataFrame, found: DataFrame) -> DataFrame:
    """The nodes of clusters of several blocks with the component each has so far."""
    return durable(large.join(found.select(F.col("node").alias("id"), F.col("component").alias("comp")), "id", "left").withColumn("comp", F.coalesce("comp", "id")), "comps")


def _mixed(nodes: DataFrame, now: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What is to be compared in buckets with nodes of several components: all their nodes, by block; and those outside the bucket's largest component, by part, where a bucket has several blocks."""
    placed = durable(nodes.select("id", "bands").join(now.select("id", "comp"), "id"), "placed").select("id", "comp", F.explode("bands").alias("bucket"))
    counted = placed.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("n"))
    mixed = counted.groupBy("bucket").agg(F.sum("n").alias("size"), F.count(F.lit(1)).alias("kinds"), F.max(F.struct("n", "comp")).alias("m")).filter("kinds > 1")
    mixed = mixed.select("bucket", F.col("m.comp").alias("main"), F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks"), F.ceil((F.col("size") - F.col("m.n")) / BLOCK).cast("int").alias("parts"))
    members = placed.join(mixed, "bucket").withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int")).withColumnRenamed("bucket", "cluster")
    members = durable(members.withColumn("parts", F.when(F.col("blocks") > 1, F.col("parts")).otherwise(1)), "mixed")
    rest = members.filter("blocks > 1 and comp <> main").withColumn("part", F.pmod(F.xxhash64("id", F.lit(5)), F.col("parts")).cast("int"))
    return members, rest


def _compared(docs: DataFrame, nodes: DataFrame, others: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """Links between all blocks of ``nodes`` and the parts (``parts`` in number) of ``others`` of the same cluster: each pair of block and part is one group."""
    mine = nodes.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select("id", "cluster", "comp", "block", "part", F.lit(0).alias("side"))
    theirs = others.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("id", "cluster", "comp", "block", "part", F.lit(1).alias("side"))
    pairs = durable(mine.union(theirs), "pairs")
    return _texts_of(docs, pairs, id_col, text_col).groupBy("cluster", "block", "part").applyInArrow(lambda t: _across(t, k, num, den), "a long, b long")

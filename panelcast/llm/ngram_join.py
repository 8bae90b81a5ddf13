"""N-gram Jaccard join by vertical partitioning.

A document is the set of its distinct word n-grams. All n-grams have one
global order (that of their XXH64 value, so no table of counts has to be
shipped), and the order is cut into fragments. Every set falls into one
segment per fragment.

* Nomination. Two sets of Jaccard similarity at least ``percent`` / 100 differ
  in at most D n-grams, D following from their sizes. The order is cut into
  more than D fragments, so the two sets agree in a whole segment: sets that
  share one meet in a bucket. The number of fragments depends on the size
  class; a set takes part in the classes of all sizes a larger partner may have.
  An empty segment proves nothing, so a set is cut again along another order,
  and again, until more of its segments hold n-grams than can differ. A
  pair meets in the first order in which either set has that many.
* Counting. For a nominated pair the overlap is counted fragment by fragment
  (``COUNT_FRAGMENTS`` cuts of the global order, each joined on its own) and
  the partial overlaps are summed per pair: 100 * overlap >= percent * union decides.

Equal sets are one node. A partner lacks few of a set's n-grams, so it shares
one of the rarest: under these n-grams the nominated sets meet for counting. It is enough that a
pair meets under its rarest common n-gram, where all rarer ones of either set are missing in the other: their number bounds
the overlap, which leaves out most pairs, also within a large group of near copies. Under an n-gram the
sets are compared with a few hubs per round, never with each other: sets that the rounds
have linked need no comparison any more, hubs whose pairs are all decided leave,
and the number of hubs grows by HUB_GROWTH, until every n-gram has sets of one
component only. So every pair that may be linked across components has been counted when the rounds end.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import materialise, release, scan_texts
from panelcast.llm.components import connected_components
from panelcast.llm.simhash import shingle_hashes

PERCENT = 90
LEAST_PERCENT = 70
CLASS_RATIO = 1.25
COUNT_FRAGMENTS = 8
HUB_GROWTH = 64
BROADCAST_ROWS = 200_000  # of 24 bytes each
FLUSH = 200_000  # n-grams held before a block is worked off; a longer text is a block of its own

_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = (x + np.uint64(salt * 0xBF58476D1CE4E5B9 & 2**64 - 1)) * _M1
    x = (x ^ (x >> np.uint64(32))) * _M2
    return x ^ (x >> np.uint64(29))


def most_differing(total: int, percent: int) -> int:
    """Most n-grams in one of two linked sets only, for sets of ``total`` n-grams together."""
    return total * (100 - percent) // (100 + percent)


class SizeClasses:
    """Classes of set sizes such that a linked partner is at most one class away, and the fragments of each."""

    def __init__(self, percent: int):
        if not LEAST_PERCENT <= percent <= 100:
            raise ValueError(f"percent must be {LEAST_PERCENT} to 100: below, a set may have too few n-grams to fill more segments than can differ")
        self.percent = percent
        self.ends, self.fragments = [], []
        lo = 1
        while lo < 1 << 40:
            hi = max(int(lo * CLASS_RATIO), 100 * lo // percent)
            most = most_differing(2 * hi, percent)
            empty = most * math.exp(-lo / (most + 1))  # segments that stay empty by chance
            spare = 0 if empty < 0.2 else math.ceil(2 * empty) + 1
            self.ends.append(hi)
            self.fragments.append(most + 1 + spare)
            lo = hi + 1

    def of(self, size: int) -> list[int]:
        """Classes in which a set meets its partners; none where only equal sets can be linked."""
        largest = 100 * size // self.percent
        if most_differing(size + largest, self.percent) < 1:
            return []
        return sorted({bisect_left(self.ends, size), bisect_left(self.ends, largest)})

    def differing(self, size: int, size_class: int) -> int:
        """Most segments in which a set differs from a linked partner that it meets in the class."""
        return most_differing(size + max(size, min(self.ends[size_class], 100 * size // self.percent)), self.percent)


def signatures(hashes: np.ndarray, sizes: np.ndarray, classes: SizeClasses) -> list[np.ndarray]:
    """Per set (``sizes`` n-grams each, one after the other) the bucket keys of its segments."""
    starts = np.cumsum(sizes) - sizes
    out: list[list[np.ndarray]] = [[] for _ in sizes]
    pending = [(d, c) for d, n in enumerate(sizes.tolist()) for c in classes.of(n)]
    order = 0
    while pending:
        who = np.array([d for d, _ in pending], dtype=np.int64)
        k = np.array([classes.fragments[c] for _, c in pending], dtype=np.int64)
        need = [classes.differing(int(sizes[d]), c) for d, c in pending]
        n = sizes[who]
        first = np.cumsum(n) - n
        item = np.repeat(np.arange(len(who)), n)
        h = hashes[np.arange(int(n.sum())) - first[item] + starts[who][item]]
        place = h if order == 0 else _mix(h, order)
        base = np.cumsum(k) - k
        segment = ((place >> np.uint64(32)) * k[item].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        code, size = base[item] + segment, int(k.sum())
        value = _mix(h, 77)
        held = np.bincount(code, minlength=size)
        low = np.bincount(code, weights=(value & np.uint64(0xFFFFFFFF)).astype(np.float64), minlength=size).astype(np.uint64)
        high = np.bincount(code, weights=(value >> np.uint64(32)).astype(np.float64), minlength=size).astype(np.uint64)
        owner = np.repeat(np.arange(len(who)), k)
        kind = np.array([c for _, c in pending], dtype=np.uint64)[owner] * np.uint64(4096) + np.uint64(order)
        key = _mix(_mix(_mix(low, 1) + high, 2) + kind, 3) + _mix((np.arange(size) - base[owner]).astype(np.uint64), 4)
        full = np.add.reduceat((held > 0).astype(np.int64), base)
        for i, (a, m) in enumerate(zip(base.tolist(), k.tolist())):
            out[who[i]].append(key[a:a + m][held[a:a + m] > 0])
        pending = [p for p, m, least in zip(pending, full.tolist(), need) if m <= least]
        order += 1
    return [np.concatenate(o) if o else np.zeros(0, np.uint64) for o in out]


def _blocks(texts: Iterator, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n-gram hashes, sizes) of the sets of some texts at a time; a set's hashes are distinct and ascending."""
    found, held = [], 0
    for t in texts:
        h = np.unique(np.array(shingle_hashes(t.as_py(), width), dtype=np.uint64))
        found.append(h)
        held += len(h)
        if held > FLUSH:
            yield np.concatenate(found), np.array(list(map(len, found)), dtype=np.int64)
            found, held = [], 0
    if found:
        yield np.concatenate(found), np.array(list(map(len, found)), dtype=np.int64)


def set_keys(hashes: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """128 bits per set, equal for equal sets."""
    parts = []
    for salt in (11, 12):
        v = _mix(_mix(hashes, salt), salt + 10)
        s = np.zeros(len(sizes), dtype=np.uint64)
        full = np.nonzero(sizes)[0]
        if len(full):
            s[full] = np.add.reduceat(v, (np.cumsum(sizes) - sizes)[full])
        parts.append(_mix(s + sizes.astype(np.uint64), salt))
    return [a.tobytes() + b.tobytes() for a, b in zip(*parts)]


def shingle_sets(df: DataFrame, id_col: str, text_col: str, width: int = 3, percent: int = PERCENT) -> DataFrame:
    """(id, n, set_key, buckets), one row per input row; null and wordless texts have n = 0 and no buckets."""
    classes = SizeClasses(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for hashes, sizes in _blocks(batch.column(1), width):
                keys = signatures(hashes, sizes, classes)
                offsets = np.concatenate([[0], np.cumsum(list(map(len, keys)))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(sizes)), pa.array(sizes), pa.array(set_keys(hashes, sizes), pa.binary()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys).view(np.int64)))],
                    names=["id", "n", "set_key", "buckets"])
                at += len(sizes)

    kind = df.schema[id_col].dataType.simpleString()
    return scan_texts(df, [id_col, text_col], run, f"id {kind}, n bigint, set_key binary, buckets array<bigint>")


def _segments(df: DataFrame, id_col: str, text_col: str, nodes: DataFrame, width: int) -> DataFrame:
    """(node, n, fragment, grams) of the sets named by ``nodes(node, least, set_key)``, from the whole texts again."""
    if nodes.count() <= BROADCAST_ROWS:
        nodes = F.broadcast(nodes)
    texts = df.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text")).join(
        nodes, F.col("__id").eqNullSafe(F.col("least"))).select("node", "set_key", "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for hashes, sizes in _blocks(batch.column(2), width):
                rows = []
                ends = np.cumsum(sizes)
                for i, key in enumerate(set_keys(hashes, sizes)):
                    if key != batch.column(1)[at + i].as_py():  # a row of the same id with another text
                        continue
                    h = hashes[ends[i] - sizes[i]:ends[i]]
                    cuts = np.searchsorted(h >> np.uint64(32), np.arange(1, COUNT_FRAGMENTS) * (2**32 // COUNT_FRAGMENTS))
                    node = batch.column(0)[at + i].as_py()
                    rows += [(node, int(sizes[i]), f, x.view(np.int64)) for f, x in enumerate(np.split(h, cuts)) if len(x)]
                at += len(sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], t) for k, t in enumerate(
                        (pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int64())))],
                    names=["node", "n", "fragment", "grams"])

    found = materialise(texts.mapInArrow(run, "node bigint, n bigint, fragment int, grams array<bigint>"), "segments")
    repeated = found.groupBy("node", "fragment").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    return found if repeated.isEmpty() else found.dropDuplicates(["node", "fragment"])  # rows of equal id and text


def _possible(overlap: Column, sizes: Column, percent: int) -> Column:
    """Whether sets with ``sizes`` n-grams together may be linked if they share at most ``overlap``."""
    return (100 + percent) * overlap >= percent * sizes


def _count(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The linked ones of ``pairs(u, v)``: partial overlaps of each fragment, summed per pair."""
    left = segments.select(F.col("node").alias("u"), F.col("n").alias("n_u"), "fragment", F.col("grams").alias("grams_u"))
    right = segments.select(F.col("node").alias("v"), F.col("n").alias("n_v"), "fragment", F.col("grams").alias("grams_v"))
    partial = pairs.join(left, "u").join(right, ["v", "fragment"]).select(
        "u", "v", "n_u", "n_v", F.size(F.array_intersect("grams_u", "grams_v")).cast("bigint").alias("overlap"))
    return (
        partial.groupBy("u", "v").agg(F.sum("overlap").alias("o"), F.max("n_u").alias("a"), F.max("n_v").alias("b"))
        .where(_possible(F.col("o"), F.col("a") + F.col("b"), percent)).select("u", "v")
    )


def link_sets(nodes: DataFrame, df: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> DataFrame:
    """(node, root): components of the distinct sets ``nodes(node, least, set_key, buckets)``; sets without links may be absent."""
    spark = df.sparkSession
    met = nodes.select(F.explode("buckets").alias("bucket"), "node")
    shared = met.groupBy("bucket").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo < hi").select("bucket")
    named = met.join(shared, "bucket").select("node").distinct()
    wanted = materialise(nodes.join(named, "node").select("node", "least", "set_key"), "wanted")
    segments = _segments(df, id_col, text_col, wanted, width)
    release(wanted)
    members = materialise(_rare_buckets(segments, percent), "members")
    links, roots, hubs = None, None, 1
    while True:
        placed = members.withColumn("comp", F.col("node")) if roots is None else members.join(roots, "node", "left").select(
            "bucket", "node", "n", "ahead", F.coalesce("root", "node").alias("comp"))
        mixed = placed.groupBy("bucket").agg(
            F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("least"), F.max(F.col("n") - F.col("ahead")).alias("most"),
        ).where("lo < hi").drop("lo", "hi")
        meeting = _possible(F.least(F.col("n") - F.col("ahead"), "most"), F.col("n") + F.col("least"), percent)  # with any other member
        open_members = materialise(placed.join(mixed, "bucket").where(meeting).drop("least", "most"), "open")
        release(members)
        largest = open_members.groupBy("bucket").agg(F.count(F.lit(1)).alias("held")).agg(F.max("held")).first()[0]
        if largest is None:
            release(open_members)
            break
        as_hub = F.struct(F.col("ahead").alias("hub_ahead"), F.col("node").alias("hub"), F.col("n").alias("hub_n"), F.col("comp").alias("hub_comp"))
        if hubs == 1:  # the member with the fewest rarer n-grams is likely amid the others
            chosen = open_members.groupBy("bucket").agg(F.min(as_hub).alias("h")).select("bucket", "h.*")
        else:  # members of the rarest components first: they are what a large component must still be compared with
            rare = open_members.groupBy("bucket", "comp").agg(F.count(F.lit(1)).alias("held"))
            place = Window.partitionBy("bucket").orderBy("held", "ahead", "node")
            chosen = open_members.join(rare, ["bucket", "comp"]).withColumn("place", F.row_number().over(place)).where(
                F.col("place") <= hubs).select("bucket", as_hub.alias("h")).select("bucket", "h.*")
        chosen = materialise(chosen, "hubs")
        overlap = F.least(F.col("n") - F.col("ahead"), F.col("hub_n") - F.col("hub_ahead"))
        meets = (open_members["bucket"] == chosen["bucket"]) & (F.col("comp") != F.col("hub_comp")) & _possible(
            overlap, F.col("n") + F.col("hub_n"), percent)
        pairs = open_members.join(chosen, meets).select(F.greatest("node", "hub").alias("u"), F.least("node", "hub").alias("v")).distinct()
        found = materialise(_count(pairs, segments, percent), "found")
        links = found if links is None else links.union(found)
        if largest <= hubs + 1:  # every member but one was a hub: all pairs are decided
            release(open_members), release(chosen)
            break
        members = materialise(open_members.join(
            chosen.select("bucket", F.col("hub").alias("node")), ["bucket", "node"], "left_anti").select("bucket", "node", "n", "ahead"), "members")
        release(open_members), release(chosen)
        roots = connected_components(links)
        hubs *= HUB_GROWTH
    release(segments)
    if links is None:
        return spark.createDataFrame([], "node bigint, root bigint")
    return roots if largest is None else connected_components(links)


def _rare_buckets(segments: DataFrame, percent: int) -> DataFrame:
    """(bucket, node, n, ahead): the nominated sets under the rarest n-grams that any partner must share one of.

    A partner may lack a bounded number of a set's n-grams, so it holds one of
    the set's rarest ones, one more than that number (rarity counted among the nominated sets, equal counts by
    the n-gram's value), and the set holds one of the partner's. The rarest n-gram that both hold is among these for
    either, and the partner has none of the ``ahead`` n-grams of a set that come before it: under this n-gram every linked
    pair keeps within the bounds, under others it need not.
    """
    grams = segments.select("node", "n", F.explode("grams").alias("bucket"))
    held = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("held"))
    smallest = F.ceil(F.col("n") * percent / 100)  # a partner's least size
    spare = F.col("n") - F.ceil((F.col("n") + smallest) * percent / (100 + percent))
    place = F.row_number().over(Window.partitionBy("node").orderBy("held", "bucket"))
    rarest = grams.join(held, "bucket").withColumn("ahead", place.cast("bigint") - 1).where(F.col("ahead") <= spare)
    keyed = rarest.where("held > 1").select("bucket", "node", "n", "ahead")
    least = keyed.groupBy("bucket").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("size")).where("size > 1")
    chance = _possible(F.col("n") - F.col("ahead"), F.col("n") + F.greatest(smallest, F.col("least")), percent)
    return keyed.join(least, "bucket").where(chance).select("bucket", "node", "n", "ahead")


def jaccard_join(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                 percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id), one row per input row.

    ``component_id`` is the smallest id reachable over links, the row's own
    included. Null and wordless texts have no n-grams and no links; a text
    with fewer than ``width`` words has its whole sequence as one n-gram.
    Equal sets are linked, so repeated rows share a component; null ids are
    ignored by the minimum. N-grams are compared by XXH64, sets by 128 bits. An empty frame gives an empty result.
    """
    sets = materialise(shingle_sets(df, id_col, text_col, width, percent), "sets")
    one = sets.where("n > 0").groupBy("set_key").agg(F.min("id").alias("least"), F.first("buckets").alias("buckets"))
    nodes = materialise(one.withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = link_sets(nodes, df, id_col, text_col, width, percent)
    named = nodes.select("node", "least", "set_key").join(roots, "node", "left").select(
        "set_key", "least", F.coalesce("root", "node").alias("root"))
    least = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_key = named.join(least, "root").select("set_key", "component_id")
    return sets.select("id", "n", "set_key").join(by_key, "set_key", "left").select(
        "id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def op11_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return jaccard_join(docs, "doc_id", "text", width=3, percent=90).select(
        F.col("id").alias("doc_id"), "n_shingles", "component_id")

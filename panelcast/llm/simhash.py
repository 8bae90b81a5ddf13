"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at distance <= r meet in the middle: each emits the variants
within half the radius, and equal variants collide. For an odd r the odd bit
is covered by deleting one of ``BLOCKS`` equal bit blocks: if a pair differs
in r bits, the deletion of a block that holds one of them leaves r-1, so
balls of radius (r-1)/2 around the remaining bits meet. With r = 3 a
fingerprint emits 4 x (1 + 48) = 196 variants; two half-balls of radius 2 would need
2,081. Colliding pairs are verified on all 64 bits.

Variants travel as packed arrays, one blob per (batch, bucket). A bucket
holds distinct fingerprints only, and its verified links leave as a spanning
forest (at most one row per fingerprint), never as pairs of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from panelcast.llm.common import lower_words_of, materialise, scan_texts
from panelcast.llm.components import connected_components

SEED = 42
BLOCKS = 4
VARIANTS_PER_BUCKET = 3_000_000
LONG_RUN = 16_384

_LANES = np.zeros(256, dtype=np.uint64)  # byte -> eight one-byte counters
for _j in range(8):
    _LANES |= ((np.arange(256, dtype=np.uint64) >> np.uint64(_j)) & np.uint64(1)) << np.uint64(8 * _j)


def shingle_hashes(text: str | None, width: int) -> list[int]:
    """XXH64 of every ``width``-word shingle, repeats included; fewer words: the whole sequence; none: nothing."""
    words = lower_words_of(text)
    digest = xxhash.xxh64_intdigest
    joined = b" ".join(words)
    if len(words) <= width:
        return [digest(joined, SEED)] if words else []
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - width + 1].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[width - 1:].tolist())]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Per document the bits set in over half of its hashes; ``counts`` are the hashes per document."""
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.nonzero(counts)[0]
    if not len(full):
        return out
    sizes = counts[full]
    blocks = -(-sizes // 255)  # one-byte counters hold 255 rows
    first = np.repeat(np.cumsum(sizes) - sizes, blocks)
    inside = np.arange(blocks.sum()) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    lanes = _LANES[hashes.view(np.uint8).reshape(-1, 8)]
    per_block = np.add.reduceat(lanes, first + 255 * inside, axis=0).view(np.uint8).reshape(-1, 64).astype(np.int64)
    per_doc = np.add.reduceat(per_block, np.cumsum(blocks) - blocks, axis=0)
    bits = (2 * per_doc > sizes[:, None]).astype(np.uint8)
    out[full] = np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(df: DataFrame, id_col: str, text_col: str, width: int = 3) -> DataFrame:
    """(id, fp bigint): the 64-bit SimHash of each whole text; null or wordless texts have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, hashes, counts = [], [], []

            def flush():
                if counts:
                    fps.append(majority(np.array(hashes, dtype=np.uint64), np.array(counts, dtype=np.int64)))
                    hashes.clear(), counts.clear()

            for text in batch.column(1):
                found = shingle_hashes(text.as_py(), width)
                hashes.extend(found)
                counts.append(len(found))
                if len(hashes) > 200_000:
                    flush()
            flush()
            fp = np.concatenate(fps) if fps else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp.view(np.int64))], names=["id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return scan_texts(df, [id_col, text_col], run, f"id {kind}, fp bigint")


def _geometry(radius: int, blocks: int) -> tuple[list[np.uint64], list[np.ndarray]]:
    """Kept-bit masks and, per mask, the flips of up to radius // 2 kept bits."""
    parts = [range(64 * i // blocks, 64 * (i + 1) // blocks) for i in range(blocks)] if radius % 2 else [range(0)]
    masks, flips = [], []
    for part in parts:
        deleted = sum(1 << b for b in part)
        free = [b for b in range(64) if not deleted >> b & 1]
        masks.append(np.uint64(~deleted & (2**64 - 1)))
        flips.append(np.array(
            [sum(1 << b for b in c) for k in range(radius // 2 + 1) for c in combinations(free, k)], dtype=np.uint64))
    return masks, flips


def _emit(fp: np.ndarray, masks, flips, per_block: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(bucket, fingerprints, variant numbers) blobs of one batch of fingerprints."""
    for i, (mask, flip) in enumerate(zip(masks, flips)):
        keys = ((fp & mask)[:, None] ^ flip[None, :]).ravel()
        bucket = _mix(keys) % np.uint64(per_block)
        order = np.argsort(bucket, kind="stable")
        which, variant = order // len(flip), (order % len(flip)).astype(np.uint16)
        ordered = bucket[order]
        cut = np.nonzero(np.diff(ordered, prepend=ordered[:1] + np.uint64(1)))[0]
        for a, b in zip(cut, np.append(cut[1:], len(order))):
            yield i * per_block + int(ordered[a]), fp[which[a:b]].tobytes(), variant[a:b].tobytes()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(33)


def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    p = parent[x]
    while True:
        q = parent[p]
        if np.array_equal(p, q):
            return p
        p = q


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    while len(a):
        ra, rb = _find(parent, a), _find(parent, b)
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))


def link_runs(keys: np.ndarray, node: np.ndarray, value: np.ndarray, mask: np.uint64, radius: int,
              parent: np.ndarray, long_run: int = LONG_RUN) -> None:
    """Union all nodes that share a key and differ in at most ``radius`` bits (rows sorted by key)."""
    start, last = np.searchsorted(keys, keys, side="left"), np.searchsorted(keys, keys, side="right")
    long = (last - start > long_run) & (radius == 3)
    for a in np.unique(start[long]):
        _link_long(keys[a], node[a:last[a]], value[a:last[a]], mask, parent)
    alive = np.nonzero(~long)[0]
    step = 1
    while True:
        alive = alive[alive + step < last[alive]]
        if not len(alive):
            return
        other = alive + step
        near = np.bitwise_count(value[alive] ^ value[other]) <= radius
        _union(parent, node[alive[near]], node[other[near]])
        step += 1


def _link_long(key: np.uint64, node: np.ndarray, value: np.ndarray, mask: np.uint64, parent: np.ndarray) -> None:
    """A long run at radius 3 without comparing all its pairs.

    Members are (deleted bits D, flip f) with at most one flipped bit, so two
    of them are 0, 1 or 2 kept bits apart. Links: equal D or D one bit apart
    always; D two bits apart if f is equal or one f is empty; D three bits
    apart if f is equal. Every member looks up the D it could link to.
    """
    part = value & ~mask
    classes, of = np.unique(part, return_inverse=True)
    first = np.zeros(len(classes), dtype=np.int64)
    first[of[::-1]] = node[::-1]
    _union(parent, node, first[of])
    bits = [np.uint64(1 << b) for b in range(64) if not int(mask) >> b & 1]
    for bit in bits:
        at = np.minimum(np.searchsorted(classes, classes ^ bit), len(classes) - 1)
        hit = classes[at] == classes ^ bit
        _union(parent, first[hit], first[at[hit]])
    order = np.argsort(value)
    value, node = value[order], node[order]
    for k in (2, 3):
        for some in combinations(bits, k):
            change = np.bitwise_or.reduce(np.array(some, dtype=np.uint64))
            for want in [value ^ change] + ([(value & ~mask ^ change) | key] if k == 2 else []):
                at = np.minimum(np.searchsorted(value, want), len(value) - 1)
                hit = value[at] == want
                _union(parent, node[hit], node[at[hit]])


def links(fps: DataFrame, radius: int = 3, blocks: int = BLOCKS, long_run: int = LONG_RUN) -> DataFrame:
    """(u, v) links between distinct fingerprints ``fps(fp)`` whose components are those of all pairs within ``radius`` bits."""
    spark = fps.sparkSession
    masks, flips = _geometry(radius, blocks)
    rows = fps.count()
    per_block = max(-(-spark.sparkContext.defaultParallelism // len(masks)),
                    -(-rows * len(flips[0]) // VARIANTS_PER_BUCKET), 1)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for a in range(0, len(fp), 8192):
                got = list(_emit(fp[a:a + 8192], masks, flips, per_block))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.binary()),
                     pa.array([g[2] for g in got], pa.binary())], names=["bucket", "fps", "variants"])

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = np.frombuffer(b"".join(pdf["fps"]), dtype=np.uint64)
        variant = np.frombuffer(b"".join(pdf["variants"]), dtype=np.uint16)
        block = int(pdf["bucket"].iloc[0]) // per_block
        keys = (fp & masks[block]) ^ flips[block][variant]
        order = np.argsort(keys)
        keys, fp = keys[order], fp[order]
        shared = np.zeros(len(keys), dtype=bool)
        same = keys[1:] == keys[:-1]
        shared[1:] |= same
        shared[:-1] |= same
        keys, fp = keys[shared], fp[shared]
        distinct, node = np.unique(fp, return_inverse=True)
        parent = np.arange(len(distinct))
        link_runs(keys, node, fp, masks[block], radius, parent, long_run)
        root = _find(parent, np.arange(len(distinct))) if len(distinct) else parent
        moved = root != np.arange(len(distinct))
        return pd.DataFrame({"u": distinct[moved].view(np.int64), "v": distinct[root[moved]].view(np.int64)})

    tasks = max(spark.sparkContext.defaultParallelism, rows // 65_536)
    packed = fps.select("fp").repartition(tasks).mapInArrow(emit, "bucket bigint, fps binary, variants binary")
    return packed.groupBy("bucket").applyInPandas(verify, "u bigint, v bigint").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                    radius: int = 3) -> DataFrame:
    """(id, fp, component_id, component_fp): one row per input row.

    ``component_id`` is the smallest id reachable over links of at most
    ``radius`` differing bits, the row's own included; null ids are ignored by
    the minimum (a component of null ids only has a null id) and
    ``component_fp`` names the component in any case. Null, empty and wordless
    texts share fingerprint zero. Repeated rows get equal results.
    """
    docs = materialise(fingerprints(df, id_col, text_col, width), "simhash")
    distinct = materialise(docs.groupBy("fp").agg(F.min("id").alias("least")), "fps")
    roots = connected_components(links(distinct, radius))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("component_fp"))
    least = named.groupBy("component_fp").agg(F.min("least").alias("component_id"))
    by_fp = named.join(least, "component_fp").select("fp", "component_fp", "component_id")
    return docs.join(by_fp, "fp").select("id", "fp", "component_id", "component_fp")


def keep_one_per_group(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3,
                       radius: int = 3) -> DataFrame:
    """One row of each component, all columns as they are: a row with the component's smallest id.

    A component of null ids only keeps a row with a null id. Where ids repeat,
    one of the rows with the kept id stays.
    """
    found = materialise(near_duplicates(df, id_col, text_col, width, radius), "groups")
    kept = found.groupBy("component_fp").agg(F.min("component_id").alias("__id")).select("__id", "component_fp")
    is_kept = F.col(f"`{id_col}`").eqNullSafe(F.col("__id"))
    repeated = found.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.col("id").isNull()).limit(1)
    if not repeated.count():  # ids are unique: the id alone names the row
        return df.join(kept.select("__id"), is_kept, "left_semi")
    # Rows of a kept id may differ in text: the fingerprint decides, then one row per component stays.
    named = kept.withColumnRenamed("component_fp", "__component")
    by_id = found.join(named, F.col("id").eqNullSafe(F.col("__id")) & (F.col("component_fp") == F.col("__component"))).select(
        "__id", "__component", "fp").distinct()
    marked = fingerprints_beside(df, text_col, width)
    out = marked.join(by_id, is_kept & (F.col("__fp") == F.col("fp")))
    return out.dropDuplicates(["__component"]).select(*[F.col(f"`{c}`") for c in df.columns])


def fingerprints_beside(df: DataFrame, text_col: str, width: int = 3) -> DataFrame:
    """``df`` with the fingerprint of its text as ``__fp``."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_hashes(t.as_py(), width) for t in batch.column(at)]
            counts = np.array([len(f) for f in found], dtype=np.int64)
            hashes = np.array([h for f in found for h in f], dtype=np.uint64)
            fp = pa.array(majority(hashes, counts).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, fp], names=[*batch.schema.names, "__fp"])

    return df.mapInArrow(run, StructType([*df.schema.fields, StructField("__fp", LongType())]))


def op9_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, "doc_id", "text", width=3, radius=3).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )

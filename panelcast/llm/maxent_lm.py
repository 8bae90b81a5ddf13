"""Hashed maximum-entropy language model with a class-factored softmax.

A word is a path of up to three choices, each out of at most ``WIDTH``: a group
of classes, the class, and for a class of several words a part of it (by the
word's hash). P(word | history) is the product of the choices' softmaxes times
the word's discounted share of its part, so context reaches into the classes and a token needs
some 20 outputs instead of one per class.

* Classes: the most frequent words alone, the text end, one class of rare
  words (training count 1 or 2, and the one symbol for all unknown words), and clusters of word
  endings. Endings are clustered by k-means on the frequent words before them.
* Every choice is a maximum-entropy model over hashed features of the
  history: the previous word, the word pair, and two skip features (the words two and
  three places back). Feature and choice together are hashed into one table
  of weight rows, whose length follows the training tokens (``TOKENS_PER_ROW``, at most ``MOST_ROWS``).
* In the rare class the mass of unknown, once- and twice-seen words follows their counts of counts.

Every step is a Spark job over all training tokens: word counts (a shuffle
of each chunk's distinct words, packed by word bucket, and back), counts of the choices,
then gradient rounds. In a round the tasks add up the gradient over all their training tokens at
fixed weights; the vectors are added up slice by slice in a tree of tasks, and
the driver applies one step scaled by the feature counts. The first round
starts from the shares of the choices, which depend on the choice's node only, and steps by log-odds. Scoring runs over the same
encoded chunks in numpy batches.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import materialise, release, remainder_of_id

SINGLES = 32  # words with a class of their own
ENDINGS = 512  # hashed word endings
CLUSTERS = 28
WIDTH = 8  # outputs of a choice
HISTORY = 65_536  # numbers of a history word; the last one is the text start
TEMPLATES = 4
ROUNDS = 3
DISCOUNT = 0.7
START_SHARE = 0.45  # of the log-odds of a single feature in the first step
SMOOTHING = 20.0
CHUNK_BYTES = 2_500_000
PAIRS_PER_BUCKET = 400_000
TOKENS_PER_ROW, LEAST_ROWS, MOST_ROWS = 1024, 2**14, 2**20  # of the weight table
BATCH = 16_384  # tokens of a numpy batch; its arrays stay in the processor's cache
BLOCK = 24  # choices of batches that are added up together
MOST_LOGIT = 60.0
TASK_TOKENS = 6_000_000
SLICES, FAN_IN = 16, 48

END, RARE = SINGLES, SINGLES + 1
GROUPS = SINGLES + 2 + ENDINGS
CLASSES = SINGLES + 2 + CLUSTERS
SUPERS = -(-CLASSES // WIDTH)
NODES = 1 + SUPERS + CLASSES  # root, groups of classes, classes


def _bytes(a: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(a, dtype=kind).tobytes()


def ending_of(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % ENDINGS


def part_of(word: bytes) -> int:
    """Part of its class that a word belongs to."""
    return part_of_hash(zlib.crc32(word))


def part_of_hash(hashed):
    return (hashed >> 7) % WIDTH


# --- chunks of tokenised text -------------------------------------------------------------------

def lower_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Number of words of each text, and the words of all, A-Z lower-cased; Arrow's ASCII white space is the six characters between words."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    n = pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    words = found.flatten()
    some = pc.greater(pc.binary_length(words), 0)  # white space at either end leaves an empty word
    before = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
    end = np.cumsum(n)
    return before[end] - before[end - n], words.filter(some)


def join_words(words: pa.Array, cut: np.ndarray) -> pa.Array:
    """The words between two cuts each, joined by spaces."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(cut, pa.int32()), words), " ").cast(pa.binary())


def tokenise(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Chunks of documents: ids, hold-out flags, token counts, tokens as numbers of the chunk's own word list.

    Number 0 is the text end. ``counts`` are the chunk's training counts.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            a = 0
            while a < batch.num_rows:
                b = 1 + int(np.searchsorted(size[:-1], (size[a - 1] if a else 0) + CHUNK_BYTES))
                ids, held, texts = (x.slice(a, b - a) for x in batch.columns)
                n, words = lower_words(texts)
                coded, lengths = words.dictionary_encode(), n + 1
                flat, is_word = np.zeros(lengths.sum(), dtype=np.int32), np.ones(lengths.sum(), dtype=bool)
                is_word[np.cumsum(lengths) - 1] = False
                flat[is_word] = coded.indices.to_numpy() + 1
                training = ~np.repeat(held.to_numpy(zero_copy_only=False), lengths)
                distinct = coded.dictionary
                counts = np.bincount(flat[training], minlength=len(distinct) + 1)
                whole = pa.array([0, b - a], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f"{part}-{number}"]), pa.ListArray.from_arrays(whole, ids), pa.ListArray.from_arrays(whole, held),
                     pa.ListArray.from_arrays(whole, pa.array(lengths, pa.int32())), pa.array([flat.tobytes()], pa.binary()),
                     join_words(distinct, np.array([0, len(distinct)])), pa.array([_bytes(counts, np.int32)], pa.binary()),
                     pa.array([len(distinct)], pa.int64())],
                    names=["chunk", "ids", "held", "lengths", "tokens", "words", "counts", "n_words"])
                a, number = b, number + 1

    return docs.select(
        F.col(f"`{id_col}`").alias("id"), (remainder_of_id(id_col, 7) == 2).alias("held"), F.col(f"`{text_col}`").alias("text"),
    ).mapInArrow(run, f"chunk string, ids array<{kind}>, held array<boolean>, lengths array<int>, tokens binary, "
                      "words binary, counts binary, n_words bigint")


def _hashes(words: list[bytes], start: int = 0) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words, repeat(start)), dtype=np.int64, count=len(words))


def _by_bucket(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of a word list by bucket, and the bucket of each word."""
    bucket = hashes % buckets
    return np.argsort(bucket.astype(np.uint16) if buckets <= 2**16 else bucket, kind="stable"), bucket  # 16 bits are sorted by radix


@dataclass
class CorpusStatistics:
    """Counts over all training tokens; ``top``: the most frequent words, most frequent first."""

    tokens: int
    distinct: int
    of_count: np.ndarray  # words seen once, twice, three times
    mass: np.ndarray  # discounted counts of the other words per ending and part
    top: list[tuple[bytes, int]]


def count_words(chunks: DataFrame, buckets: int) -> DataFrame:
    """Rows (chunk, bucket, c) with the corpus counts of the chunk's words, and one row per bucket with its statistics."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, joined, counts in zip(*(batch.column(i) for i in range(3))):
                words = joined.as_py().split()
                if not words:
                    continue
                order, bucket = _by_bucket(_hashes(words), buckets)
                count = np.frombuffer(counts.as_py(), dtype=np.int32)[1:]
                cut = np.append(np.nonzero(np.diff(bucket[order], prepend=-1))[0], len(order))
                ordered = pc.ascii_split_whitespace(pa.array([joined.as_py()], pa.string())).flatten().take(pa.array(order))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[order[cut[:-1]]], pa.int64()), pa.array([chunk.as_py()] * (len(cut) - 1)), join_words(ordered, cut),
                     pa.array([_bytes(count[order[a:b]], np.int32) for a, b in zip(cut[:-1], cut[1:])], pa.binary())],
                    names=["bucket", "chunk", "words", "counts"])

    def total(pdf: pd.DataFrame) -> pd.DataFrame:
        found = pc.ascii_split_whitespace(pa.array(pdf["words"], pa.string()))
        coded = found.flatten().dictionary_encode()
        number = coded.indices.to_numpy()
        counts = np.concatenate([np.frombuffer(x, dtype=np.int32) for x in pdf["counts"]]).astype(np.float64)
        c = np.bincount(number, weights=counts, minlength=len(coded.dictionary)).astype(np.int64)
        usual = np.nonzero(c > 2)[0]
        words = coded.dictionary.take(pa.array(usual)).cast(pa.binary()).to_pylist()
        ending = _hashes([w[-3:] for w in words]) % ENDINGS
        mass = np.bincount(ending * WIDTH + part_of_hash(_hashes(words)), weights=c[usual] - DISCOUNT, minlength=ENDINGS * WIDTH)
        top = heapq.nsmallest(SINGLES, zip((-c[usual]).tolist(), words))
        stats = [c.sum(), (c > 0).sum(), *((c == k).sum() for k in (1, 2, 3))]
        cut = np.cumsum(found.value_lengths().to_numpy())[:-1]
        out = [(x, int(pdf["bucket"].iloc[0]), n.tobytes(), None, None, None) for x, n in zip(pdf["chunk"], np.split(c[number], cut))]
        out.append((None, int(pdf["bucket"].iloc[0]), _bytes(np.array(stats), np.int64), _bytes(mass, np.float64),
                    b" ".join(w for _, w in top), _bytes(np.array([-n for n, _ in top]), np.int64)))
        return pd.DataFrame(out, columns=["chunk", "bucket", "c", "mass", "top", "top_c"])

    return (
        chunks.select("chunk", "words", "counts").mapInArrow(deal, "bucket bigint, chunk string, words binary, counts binary")
        .groupBy("bucket").applyInPandas(total, "chunk string, bucket bigint, c binary, mass binary, top binary, top_c binary"))


def statistics(counted: DataFrame, ends: int) -> CorpusStatistics:
    """Sums over the buckets; each gives its counts, sums per ending and part, and at most SINGLES words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stats, mass, top = np.zeros(5, dtype=np.int64), np.zeros(ENDINGS * WIDTH), []
        for batch in batches:
            for s, m, words, c in zip(*(batch.column(i) for i in range(4))):
                stats += np.frombuffer(s.as_py(), dtype=np.int64)
                mass += np.frombuffer(m.as_py(), dtype=np.float64)
                top += zip(np.frombuffer(c.as_py(), dtype=np.int64).tolist(), words.as_py().split())
        top = heapq.nsmallest(SINGLES, ((-n, w) for n, w in top))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x], pa.binary()) for x in (
                stats.tobytes(), mass.tobytes(), b" ".join(w for _, w in top), _bytes(np.array([-n for n, _ in top]), np.int64))],
            names=["c", "mass", "top", "top_c"])

    schema = "c binary, mass binary, top binary, top_c binary"
    got = counted.where("chunk is null").select("c", "mass", "top", "top_c").mapInArrow(run, schema).collect()
    stats, mass, top = np.zeros(5, dtype=np.int64), np.zeros(ENDINGS * WIDTH), []
    for r in got:  # one row per task
        stats += np.frombuffer(r["c"], dtype=np.int64)
        mass = mass + np.frombuffer(r["mass"], dtype=np.float64)
        top += zip((-np.frombuffer(r["top_c"], dtype=np.int64)).tolist(), bytes(r["top"]).split())
    best = [(w, -n) for n, w in heapq.nsmallest(SINGLES, top)]
    for w, n in best:
        mass[ending_of(w) * WIDTH + part_of(w)] -= n - DISCOUNT
    return CorpusStatistics(int(stats[0]) + ends, int(stats[1]) + (ends > 0), stats[2:5], np.maximum(mass, 0.0), best)


def encode_chunks(chunks: DataFrame, counted: DataFrame, stats: CorpusStatistics, ends: int, buckets: int) -> DataFrame:
    """Chunks with per-document base figures and, per token, its history number and its code (group x WIDTH + part)."""
    counts = counted.where("chunk is not null").groupBy("chunk").agg(F.collect_list(F.struct("bucket", "c")).alias("found"))
    joined = chunks.join(counts, "chunk", "left").select("ids", "held", "lengths", "tokens", "words", "found")
    singles = {w: i for i, (w, _) in enumerate(stats.top)}
    least = min((n for _, n in stats.top), default=0)  # count of a single
    n1, n2, n3 = (float(x) for x in stats.of_count)
    shares = np.array([n1, 2 * n2, 3 * n3]) + 1e-9  # mass of unknown, once-seen and twice-seen words
    rare = np.log10(shares / shares.sum() / np.maximum([1.0, n1, n2], 1.0))
    divisor = np.log10(stats.tokens + stats.distinct + 1)
    kind = chunks.schema["ids"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, held, lengths, tokens, joined_words, found in zip(*(batch.column(i) for i in range(6))):
                words = joined_words.as_py().split()
                c = np.zeros(len(words) + 1, dtype=np.int64)
                c[0] = ends
                hashes = _hashes(words)
                if words:
                    order, _ = _by_bucket(hashes, buckets)
                    c[order + 1] = np.concatenate([np.frombuffer(x["c"], dtype=np.int64)
                                                   for x in sorted(found.as_py(), key=lambda x: x["bucket"])])
                group = np.append(END, SINGLES + 2 + _hashes([w[-3:] for w in words]) % ENDINGS).astype(np.uint16)
                for i in np.flatnonzero(c[1:] >= least).tolist():
                    group[i + 1] = singles.get(words[i], group[i + 1])
                within = np.log10(np.maximum(c - DISCOUNT, 1e-9))
                for k in range(3):
                    scarce = (c == k) & (group != END)
                    group[scarce], within[scarce] = RARE, rare[k]
                within[(group <= END)] = 0.0
                part = np.append(0, part_of_hash(hashes)).astype(np.uint16)
                code = group * np.uint16(WIDTH) + np.where(group > RARE, part, 0).astype(np.uint16)
                history = np.append(HISTORY - 1, _hashes(words, zlib.crc32(b"h")) % (HISTORY - 1)).astype(np.uint16)
                flat, sizes = np.frombuffer(tokens.as_py(), dtype=np.int32), np.array(lengths.as_py(), dtype=np.int64)
                at = np.cumsum(sizes) - sizes
                base = np.add.reduceat(np.log10(c + 1.0)[flat], at) - sizes * divisor
                known = np.add.reduceat((c > 0).astype(np.int64)[flat], at)
                inside = np.add.reduceat(within[flat], at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids.as_py()], ids.type), pa.array([held.as_py()], held.type), pa.array([lengths.as_py()], lengths.type),
                     *[pa.array([x], pa.binary()) for x in (base.tobytes(), known.tobytes(), inside.tobytes(),
                                                            code[flat].tobytes(), history[flat].tobytes())]],
                    names=["ids", "held", "lengths", "base", "known", "inside", "codes", "history"])

    return joined.mapInArrow(run, f"ids {kind}, held array<boolean>, lengths array<int>, base binary, known binary, "
                                  "inside binary, codes binary, history binary")


# --- model -------------------------------------------------------------------------------------

@dataclass
class Model:
    cluster: np.ndarray  # group -> class
    part_mass: np.ndarray  # CLASSES x WIDTH: log10 of the discounted counts of a part
    bias: np.ndarray  # NODES x WIDTH; very low where a node has no such child
    weights: np.ndarray  # rows x WIDTH

    def choices(self, codes: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Per level (tokens concerned, node, child) of the tokens' paths."""
        classes = self.cluster[codes // WIDTH]
        every = np.arange(len(codes))
        several = np.flatnonzero(classes > RARE)
        return [(every, np.zeros(len(codes), dtype=np.int64), classes // WIDTH),
                (every, 1 + classes // WIDTH, classes % WIDTH),
                (several, 1 + SUPERS + classes[several], (codes % WIDTH).astype(np.int64)[several])]


def words_before(history: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The words one, two and three places back (rows) at each token; a text starts after end symbols."""
    out, start = np.empty((3, len(history)), dtype=np.uint16), np.cumsum(lengths) - lengths
    for k in range(3):
        out[k, 1:] = (out[k - 1] if k else history)[:-1]
        out[k, start] = HISTORY - 1
    return out


def features_before(before: np.ndarray) -> np.ndarray:
    """Feature value of each template (rows) at each token, from the three words before it."""
    one, two, three = before.astype(np.uint64)
    return np.stack([one, one * np.uint64(HISTORY) + two, two, three])


def features_of(history: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return features_before(words_before(history, lengths))


def mix_features(features: np.ndarray) -> np.ndarray:
    """The features' share of the hash of a weight row, the same for all choices of a token."""
    template = np.arange(TEMPLATES, dtype=np.uint64)[:, None] * np.uint64(0xD6E8FEB86659FD93)
    return (features + template) * np.uint64(0x9E3779B97F4A7C15)


def weight_rows(mixed: np.ndarray, tokens: np.ndarray, node: np.ndarray, rows: int) -> np.ndarray:
    """Row of the weight table for each template and token concerned; ``rows`` is a power of two."""
    x = mixed if len(tokens) == mixed.shape[1] else np.take(mixed, tokens, axis=1)
    x = x + node.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x94D049BB133111EB)
    x >>= np.uint64(65 - rows.bit_length())
    return x.view(np.int64)


def choice_probabilities(model: Model, rows: np.ndarray, node: np.ndarray) -> np.ndarray:
    z, some = np.empty((2, len(node), WIDTH), dtype=np.float32)
    np.take(model.bias, node, axis=0, out=z, mode="clip")
    for k in range(TEMPLATES):
        z += np.take(model.weights, rows[k], axis=0, out=some, mode="clip")  # rows are in range; this mode needs no copy
    np.minimum(z, MOST_LOGIT, out=z)  # steps are bounded, so logits stay far below; no maximum per row is needed then
    np.exp(z, out=z)
    z /= (z @ np.ones(WIDTH, dtype=np.float32) + np.float32(1e-37))[:, None]  # a product is faster than a sum over a short axis
    return z


def _unpack(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple]:
    columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
    kinds = {"codes": np.uint16, "history": np.uint16, "base": np.float64, "inside": np.float64, "known": np.int64}
    for row in zip(*columns):
        yield tuple(np.frombuffer(x.as_py(), dtype=kinds[n]) if n in kinds else x.as_py() for n, x in zip(names, row))


def _training(codes: np.ndarray, history: np.ndarray, lengths: list[int], held: list[bool]) -> tuple[np.ndarray, ...]:
    """(codes, history, lengths) of the training documents."""
    sizes, kept = np.array(lengths, dtype=np.int64), ~np.array(held, dtype=bool)
    at = np.repeat(kept, sizes)
    return codes[at], history[at], sizes[kept]


def _reduce(encoded: DataFrame, size: int, tasks: int, add: Callable) -> np.ndarray:
    """Sum of a vector of fixed size over all chunks: added up per task, then per slice in groups of FAN_IN tasks, one slice at a
    time in memory; one vector reaches the driver.

    ``add`` gets chunks together until they hold a quarter of the vector's length in tokens, so
    that its work on whole vectors is a small share for a long one, too."""
    step = -(-size // SLICES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some, waiting = np.zeros(size, dtype=np.float32), False, []

        def add_waiting():
            codes, history, lengths, held = (np.concatenate(x) for x in zip(*waiting))
            waiting.clear()
            add(total, codes, history, lengths, held)

        for batch in batches:
            for piece in _unpack(batch, ["codes", "history", "lengths", "held"]):
                waiting.append(piece)
                some = True
                if sum(len(codes) for codes, *_ in waiting) >= size // 4:
                    add_waiting()
        if waiting:
            add_waiting()
        if some:
            task = TaskContext.get().partitionId()
            for i in range(SLICES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int32()), pa.array([task], pa.int32()),
                     pa.array([total[i * step:(i + 1) * step].tobytes()], pa.binary())], names=["slice", "task", "x"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        task = 0
        for batch in batches:
            for i, t, x in zip(*(batch.column(k) for k in range(3))):
                part, task = np.frombuffer(x.as_py(), dtype=np.float32), t.as_py()
                sums[i.as_py()] = sums[i.as_py()] + part if i.as_py() in sums else part.astype(np.float64)
        for i, x in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([i], pa.int32()), pa.array([task], pa.int32()), pa.array([_bytes(x, np.float32)], pa.binary())],
                names=["slice", "task", "x"])

    kind = "slice int, task int, x binary"
    found = encoded.select("codes", "history", "lengths", "held").coalesce(tasks).mapInArrow(run, kind)
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        found = found.repartition(SLICES * tasks, "slice", F.col("task") % tasks).mapInArrow(total, kind)
    out = np.zeros(size)
    for r in found.collect():  # SLICES rows, or a few more where two parts of a slice met no common task
        at = r["slice"] * step
        part = np.frombuffer(r["x"], dtype=np.float32)
        out[at:at + len(part)] += part
    return out


def cluster_endings(profile: np.ndarray, rounds: int = 15) -> np.ndarray:
    """Group -> class: singles, end and rare as they are, endings by k-means on the words before them."""
    mass = profile.sum(axis=1)
    points = np.sqrt((profile + 0.1) / (profile + 0.1).sum(axis=1, keepdims=True))
    chosen = [int(mass.argmax())]
    for _ in range(CLUSTERS - 1):  # far and heavy points first
        near = np.min([((points - points[i]) ** 2).sum(axis=1) for i in chosen], axis=0)
        chosen.append(int((near * np.sqrt(mass + 1e-9)).argmax()))
    centres = points[chosen]
    for _ in range(rounds):
        nearest = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        for k in range(CLUSTERS):
            if mass[nearest == k].sum() > 0:
                centres[k] = np.average(points[nearest == k], axis=0, weights=mass[nearest == k] + 1e-9)
    return np.concatenate([np.arange(SINGLES + 2), SINGLES + 2 + nearest]).astype(np.int64)


def train(encoded: DataFrame, stats: CorpusStatistics) -> Model:
    rows = LEAST_ROWS
    while rows < min(MOST_ROWS, stats.tokens // TOKENS_PER_ROW):
        rows *= 2
    # a task sends one vector: few enough tasks that vectors stay a small share of the data
    tasks = max(encoded.sparkSession.sparkContext.defaultParallelism, -(-stats.tokens // max(TASK_TOKENS, 64 * rows)))

    def profile(total, codes, history, lengths, held):
        codes, _, sizes = _training(codes, history, lengths, held)
        total[:GROUPS * WIDTH] += np.bincount(codes, minlength=GROUPS * WIDTH)
        groups = (codes // WIDTH).astype(np.int64)
        before = np.concatenate([groups[:1], groups[:-1]])
        before[np.cumsum(sizes) - sizes] = END
        at = np.flatnonzero((groups > RARE) & (before < END))
        total[GROUPS * WIDTH:] += np.bincount((groups[at] - RARE - 1) * SINGLES + before[at], minlength=ENDINGS * SINGLES)

    counts = _reduce(encoded, GROUPS * WIDTH + ENDINGS * SINGLES, tasks, profile)
    cluster = cluster_endings(counts[GROUPS * WIDTH:].reshape(ENDINGS, SINGLES))
    of_code = counts[:GROUPS * WIDTH].reshape(GROUPS, WIDTH)
    n1, n2, n3 = (float(x) for x in stats.of_count)
    of_code[RARE] *= (n1 + 2 * n2 + 3 * n3 + 1) / (n1 + 2 * n2 + 1)  # rare words met in new text
    model = Model(cluster, _part_mass(cluster, stats.mass), _shares(cluster, of_code), np.zeros((rows, WIDTH), dtype=np.float32))
    seen, expected = (x.T for x in _reduce(encoded, 2 * rows * WIDTH, tasks, _first_counts(model)).reshape(2, WIDTH, rows))
    model.weights += (START_SHARE * np.log((seen + SMOOTHING / WIDTH) / (expected + SMOOTHING / WIDTH))).astype(np.float32)
    for _ in range(ROUNDS - 1):
        found = _reduce(encoded, (rows + NODES) * (WIDTH - 1), tasks, _gradient(model)).reshape(WIDTH - 1, rows + NODES)
        found = np.concatenate([found, -found.sum(axis=0, keepdims=True)]).T
        model.weights += np.clip(found[:rows] / (seen + SMOOTHING / 4) / (TEMPLATES + 1), -1, 1).astype(np.float32)
        model.bias += np.clip(found[rows:] / (_children(cluster, of_code) + 1.0) / (TEMPLATES + 1), -1, 1).astype(np.float32)
    return model


def _children(cluster: np.ndarray, of_code: np.ndarray) -> np.ndarray:
    """NODES x WIDTH: training tokens that take each child of each node."""
    of_class = np.zeros((CLASSES, WIDTH))
    np.add.at(of_class, cluster, of_code)
    out = np.zeros((NODES, WIDTH))
    total = np.zeros(SUPERS * WIDTH)
    total[:CLASSES] = of_class.sum(axis=1)
    out[1:1 + SUPERS] = total.reshape(SUPERS, WIDTH)
    out[0, :SUPERS] = out[1:1 + SUPERS].sum(axis=1)
    out[1 + SUPERS:] = of_class
    return out


def _shares(cluster: np.ndarray, of_code: np.ndarray) -> np.ndarray:
    """Log shares of the children of each node; children that no word can take are out of reach."""
    n = _children(cluster, of_code) + 0.5
    exists = np.zeros((NODES, WIDTH), dtype=bool)
    exists[0, :SUPERS] = True
    exists[1:1 + SUPERS].reshape(-1)[:CLASSES] = True
    exists[1 + SUPERS:] = True
    n = np.where(exists, n, 1e-30)
    return np.log(n / n.sum(axis=1, keepdims=True)).astype(np.float32)


def _part_mass(cluster: np.ndarray, mass: np.ndarray) -> np.ndarray:
    out = np.zeros((CLASSES, WIDTH))
    np.add.at(out, cluster[SINGLES + 2:], mass.reshape(ENDINGS, WIDTH))
    return np.log10(np.maximum(out, 1e-9))


def _first_counts(model: Model):
    """Adds observed and then expected feature counts over all training documents at weights of zero.

    A choice's probabilities follow from its node alone then. So those of the first two levels, with few
    nodes, need the tokens counted per node and row only; per token they are added for the third level.
    """
    rows = len(model.weights)
    table = rows * WIDTH

    def add(total, codes, history, lengths, held):
        chances = np.exp(model.bias.astype(np.float64))
        chances /= chances.sum(axis=1, keepdims=True)
        pairs = np.ascontiguousarray(chances.view(np.complex128).T)
        codes, history, sizes = _training(codes, history, lengths, held)
        before = words_before(history, sizes)
        seen, nodes = np.zeros(table, dtype=np.int32), np.zeros((1 + SUPERS) * rows, dtype=np.int32)
        sums, found, one = np.zeros((WIDTH // 2, rows), dtype=np.complex128), [], np.ones(BATCH, dtype=np.int32)
        for a in range(0, len(codes), BATCH):
            mixed = mix_features(features_before(before[:, a:a + BATCH]))
            for tokens, node, child in model.choices(codes[a:a + BATCH]):
                if not len(tokens):
                    continue
                row = weight_rows(mixed, tokens, node, rows)
                for places in child * rows + row:
                    np.add.at(seen, places, one[:len(tokens)])
                if node[0] <= SUPERS:
                    for places in node * rows + row:
                        np.add.at(nodes, places, one[:len(tokens)])
                else:
                    found.append((row, np.take(pairs, node, axis=1)))
            if 3 * len(found) >= BLOCK:
                _scatter(sums, found)
        _scatter(sums, found)
        total[:table] += seen
        expected = total[table:].reshape(WIDTH, rows)
        expected += chances[:1 + SUPERS].T.astype(np.float32) @ nodes.reshape(1 + SUPERS, rows).astype(np.float32)
        expected += _unpaired(sums)

    return add


def _scatter(sums: np.ndarray, found: list[tuple[np.ndarray, np.ndarray]]) -> None:
    """Adds the outputs of the tokens (rows per template, outputs) to their rows, and empties the list.

    Two outputs are one complex number, which ``add.at`` adds about as fast as a single one. It touches only the
    rows met, so the time does not depend on the table's length; one pair's table at a time stays in the cache.
    ``add.at`` is slow on arrays whose dtype came out of a pickle, so both sides are made in the task.
    """
    for j, total in enumerate(sums):
        for row, pairs in found:
            for places in row:
                np.add.at(total, places, pairs[j])
    found.clear()


def _unpaired(sums: np.ndarray) -> np.ndarray:
    """WIDTH x rows."""
    return np.stack([sums.real, sums.imag], axis=1).reshape(WIDTH, -1)


def _gradient(model: Model):
    """Adds observed minus expected feature counts over all training documents, each output's
    followed by that of the biases; the last output is left out, as a token's outputs add up to zero."""
    rows = len(model.weights)

    def add(total, codes, history, lengths, held):
        codes, history, sizes = _training(codes, history, lengths, held)
        before = words_before(history, sizes)
        sums, found = np.zeros((WIDTH // 2, rows + NODES), dtype=np.complex128), []
        for a in range(0, len(codes), BATCH):
            mixed = mix_features(features_before(before[:, a:a + BATCH]))
            for tokens, node, child in model.choices(codes[a:a + BATCH]):
                if not len(tokens):
                    continue
                row = weight_rows(mixed, tokens, node, rows)
                g = choice_probabilities(model, row, node)
                np.negative(g, out=g)
                g.reshape(-1)[np.arange(len(tokens)) * WIDTH + child] += 1
                pairs = np.ascontiguousarray(g.view(np.complex64).T, dtype=np.complex128)
                found.append((row, pairs))
                if node[0]:
                    found.append((rows + node[None], pairs))
                else:  # the first level has one node
                    sums[:, rows] += pairs.sum(axis=1)
            if len(found) >= BLOCK:
                _scatter(sums, found)
        _scatter(sums, found)
        total.reshape(WIDTH - 1, rows + NODES)[:] += _unpaired(sums)[:WIDTH - 1]

    return add


def token_scores(model: Model, codes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """log10 of each token's choices, less the log10 of its part's mass (its own count is added elsewhere)."""
    out, mixed = np.zeros(len(codes)), mix_features(features_before(before))
    for tokens, node, child in model.choices(codes):
        if len(tokens):
            p = choice_probabilities(model, weight_rows(mixed, tokens, node, len(model.weights)), node)
            out[tokens] += np.log10(np.maximum(p[np.arange(len(p)), child], 1e-30))
    classes = model.cluster[codes // WIDTH]
    return out - np.where(classes > RARE, model.part_mass[classes, codes % WIDTH], 0.0)


def score_chunks(encoded: DataFrame, model: Model) -> DataFrame:
    """(id, held_out, n_tokens, n_known, base_score, score), one row per document."""
    id_kind = encoded.schema["ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["held", "lengths", "base", "known", "inside", "codes", "history"]
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            for row, (held, lengths, base, known, inside, codes, history) in enumerate(_unpack(batch, names)):
                sizes = np.array(lengths, dtype=np.int64)
                before = words_before(history, sizes)
                gain = np.empty(len(codes))
                for a in range(0, len(codes), BATCH):
                    gain[a:a + BATCH] = token_scores(model, codes[a:a + BATCH], before[:, a:a + BATCH])
                score = np.add.reduceat(gain, np.cumsum(sizes) - sizes) + inside
                yield pa.RecordBatch.from_arrays(
                    [ids[row].values, pa.array(held, pa.bool_()), pa.array(sizes), pa.array(known), pa.array(base), pa.array(score)],
                    names=["id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return encoded.mapInArrow(run, f"id {id_kind}, held_out boolean, n_tokens bigint, n_known bigint, "
                                   "base_score double, score double")


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per input row.

    Trains on the rows whose crc32(id) mod 7 is not 2 and scores all. Null
    and empty texts are one text end; ids may be null or repeated. Without training rows every token is unknown.
    """
    chunks = materialise(tokenise(docs, id_col, text_col), "chunks")
    pairs, ends = chunks.agg(
        F.coalesce(F.sum("n_words"), F.lit(0)),
        F.coalesce(F.sum(F.size(F.filter("held", lambda x: ~x))), F.lit(0))).first()
    buckets = max(docs.sparkSession.sparkContext.defaultParallelism, -(-pairs // PAIRS_PER_BUCKET))
    counted = materialise(count_words(chunks, buckets), "counts")
    stats = statistics(counted, ends)
    encoded = materialise(encode_chunks(chunks, counted, stats, ends, buckets), "encoded")
    release(chunks)
    release(counted)
    scored = score_chunks(encoded, train(encoded, stats))
    return scored.withColumn("train_tokens", F.lit(stats.tokens).cast("bigint"))


def op6_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return score_documents(docs).select(
        F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")

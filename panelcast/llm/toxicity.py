"""Toxicity by compression distance between two trained zstandard dictionaries.

Fit, on a bounded sample of labelled rows: the texts are cut at word
boundaries into pieces, which train a toxic and an ordinary dictionary; the
calibration sees each half of the rows under dictionaries of the other half. Words that both sides use alike carry
no signal, so the toxic dictionary is trained on the words that are over-represented in toxic
pieces and occur in several contexts (a copied passage has one context).

Score: every window of a text (a word; longer words in parts of at most
``MAX_WINDOW`` bytes) is compressed with either dictionary between two fixed
pads, which both dictionaries hold. The pads make sure that a match inside
the window is found and that block overhead cancels. The two lengths put the
window into a kind by fixed thresholds; the counts of the kinds go into a
logistic calibration. Equal windows are compressed once per worker.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard as zs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import lower_words_of, remainder_of_id, scan_texts
from panelcast.worker import WorkerCache

# Bounds of the fitting sample (per label): rows, pieces, bytes of a piece.
SAMPLE_ROWS = 4_000
SAMPLE_PIECES = 6_000
PIECE_BYTES = 4_096
DICTIONARY_BYTES = 2_048
SEGMENT = 24  # bytes of a segment that dictionary training picks
LEVEL = 3
OVERUSE = 10.0  # times more frequent in toxic pieces
MIN_CONTEXTS = 4
MIN_PIECES = 3
MIN_SHARE = 0.015  # of the toxic pieces
MAX_WINDOW = 64
KINDS = 8
CACHE_WORDS = 150_000  # a worker in the pipeline also holds the tables of the other stages

HEAD = bytes(range(33, 65)) + b"@~" + bytes(range(91, 123))
TAIL = HEAD[32:]


@dataclass
class Model:
    """Two raw dictionaries and the calibration; ``weights`` None: constant ``base``."""

    toxic: bytes
    ordinary: bytes
    weights: np.ndarray | None
    base: float

    def key(self) -> int:
        return zlib.crc32(self.toxic + b"|" + self.ordinary)


class Windows:
    """Kind of a window, kept per worker for windows seen before (bounded).

    Two lengths decide: the gain (bytes that the toxic dictionary saves over
    the ordinary one) and the rest (bytes that the window still costs under
    the toxic dictionary; 0 or 1: it is there as a whole).
    """

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.known: dict[bytes, int] = {}
        self._toxic, self._ordinary = (_compressor(x).compress for x in (toxic, ordinary))
        self._empty = len(self._toxic(HEAD + b"  " + TAIL))

    def kind(self, window: bytes) -> int:
        padded = HEAD + b" " + window + b" " + TAIL
        toxic = len(self._toxic(padded))
        gain, rest = len(self._ordinary(padded)) - toxic, toxic - self._empty
        size = (gain >= 3) + (gain >= 5) + (gain >= 7)
        if not size:
            return 0
        if rest <= 1:
            return 4 + size
        return (1, 3 if rest <= 4 else 2, 4)[size - 1]

    def histogram(self, words: list[bytes]) -> np.ndarray:
        """Number of windows per kind 0..KINDS-1."""
        known, out = self.known, []
        for word in words:
            kind = known.get(word)
            if kind is None:
                if len(known) >= CACHE_WORDS:
                    known.clear()
                kind = max(self.kind(word[i:i + MAX_WINDOW]) for i in range(0, len(word), MAX_WINDOW))
                if len(word) <= MAX_WINDOW:
                    known[word] = kind
            out.append(kind)
        return np.bincount(np.array(out, dtype=np.int64), minlength=KINDS)


_TABLES = WorkerCache("toxicity windows", keep=2)


def _windows(model: Model) -> Windows:
    return _TABLES.get(model.key(), lambda: Windows(model.toxic, model.ordinary))


def _compressor(content: bytes) -> zs.ZstdCompressor:
    raw = content + HEAD
    params = zs.ZstdCompressionParameters.from_level(
        LEVEL, dict_size=len(raw), source_size=192, format=zs.FORMAT_ZSTD1_MAGICLESS,
        write_content_size=False, write_checksum=False, write_dict_id=False)
    dictionary = zs.ZstdCompressionDict(raw, dict_type=zs.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=params)
    return zs.ZstdCompressor(dict_data=dictionary, compression_params=params)


def design(histograms: np.ndarray) -> np.ndarray:
    """Calibration features of kind histograms: length, windows of each kind, shares of the telling kinds."""
    n = np.maximum(histograms.sum(axis=1), 1)
    columns = [np.ones(len(n)), np.log(n)]
    columns += [np.log1p(histograms[:, k]) for k in range(1, KINDS)]
    columns += [20 * histograms[:, k:].sum(axis=1) / n for k in (3, 5)]
    return np.array(columns).T


def _logistic(x: np.ndarray, y: np.ndarray, rounds: int = 30, ridge: float = 1.0) -> np.ndarray:
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = _sigmoid(x @ w)
        hessian = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w -= np.linalg.solve(hessian, x.T @ (p - y) + ridge * w)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def pieces_of(text: str | None) -> list[bytes]:
    """A text as pieces of at most PIECE_BYTES at word boundaries (a longer word is a piece of its own, cut)."""
    out, size, words = [], 0, []
    for word in lower_words_of(text):
        word = word[:PIECE_BYTES]
        if words and size + len(word) + 1 > PIECE_BYTES:
            out.append(b" ".join(words))
            size, words = 0, []
        words.append(word)
        size += len(word) + 1
    return out + [b" ".join(words)] * bool(words)


def _samples(pieces: list[list[bytes]], keep) -> list[bytes]:
    out = []
    for words in pieces:
        kept = [w for w in words if keep(w)]
        out += [b" " + b" ".join(kept[i:i + 8]) + b" " for i in range(0, len(kept), 8)]
    return [x for x in out if len(x) > 8]


def _train(samples: list[bytes]) -> bytes:
    """A trained dictionary, as content; too few samples to train: the samples themselves."""
    try:
        return zs.train_dictionary(DICTIONARY_BYTES, samples, k=SEGMENT, d=6, level=LEVEL).as_bytes()
    except (zs.ZstdError, ValueError):
        return b"".join(samples)[:DICTIONARY_BYTES]


def train_dictionaries(toxic: list[bytes], ordinary: list[bytes]) -> tuple[bytes, bytes]:
    bad, good = [p.split() for p in toxic], [p.split() for p in ordinary]
    in_bad = Counter(w for p in bad for w in set(p))
    in_good = Counter(w for p in good for w in set(p))
    before, after = defaultdict(set), defaultdict(set)
    for words in bad:
        for i, w in enumerate(words):
            if in_bad[w] >= max(MIN_PIECES, MIN_SHARE * len(bad)) and len(before[w]) < 64:
                before[w].add(words[i - 1] if i else b"")
                after[w].add(words[i + 1] if i + 1 < len(words) else b"")

    def overused(w: bytes) -> bool:
        return (len(before[w]) >= MIN_CONTEXTS and len(after[w]) >= MIN_CONTEXTS
                and in_bad[w] / len(bad) >= OVERUSE * (in_good[w] + 1) / max(1, len(good)))

    marked = _samples(bad, overused)
    if not marked:  # too few rows for contexts: any over-represented word
        marked = _samples(bad, lambda w: in_good[w] == 0)
    usual = _samples(good, lambda w: in_good[w] >= MIN_PIECES) or _samples(good, lambda w: True)
    return _train(marked), _train(usual[:40_000])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "toxic") -> Model:
    """Fit on labelled rows whose crc32(id) mod 5 is not 0.

    At most SAMPLE_ROWS rows of each label are used, picked by id hash, so
    the driver holds at most 2 x SAMPLE_PIECES x PIECE_BYTES of text. Null
    labels are ignored. Without rows of both labels the score is the constant share of
    toxic rows (0 without labels).
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(
        F.col("y").isin(0, 1) & F.col("id").isNotNull() & (remainder_of_id("id", 5) != 0))
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS) for y in (0, 1)]
    sample = picked[0].union(picked[1]).dropDuplicates(["id"])  # at most 2 x SAMPLE_ROWS small rows: broadcast is bounded
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(
        F.broadcast(sample), "id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(i, y, n, p) for i, y, t in zip(*(batch.column(k).to_pylist() for k in range(3)))
                   for n, p in enumerate(pieces_of(t))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([g[k] for g in got], kind) for k, kind in enumerate((batch.schema.field(0).type, pa.int32(), pa.int32(), pa.binary()))],
                names=["id", "y", "n", "piece"])

    kind = docs.schema[id_col].dataType.simpleString()
    pieces = rows.select("id", F.col("y").cast("int").alias("y"), "text").mapInArrow(
        cut, f"id {kind}, y int, n int, piece binary")
    fold = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(2)).cast("int")
    texts: dict[tuple[int, int], list[bytes]] = {(k, y): [] for k in (0, 1) for y in (0, 1)}
    for y in (1, 0):
        chosen = pieces.where(F.col("y") == y).orderBy(F.xxhash64("id", "n"), "id", "n").limit(SAMPLE_PIECES)
        for r in chosen.select(fold.alias("k"), "piece").collect():
            texts[r["k"], y].append(bytes(r["piece"]))
    count = {r["y"]: r["count"] for r in sample.groupBy("y").count().collect()}
    base = count.get(1, 0) / max(1, sum(count.values()))
    if not all(texts.values()):
        return Model(b"", b"", None, base if len(count) == 1 else 0.0)
    # Calibration on windows under the dictionaries of the other fold; scoring uses the dictionaries of both folds.
    folds = [Model(*train_dictionaries(texts[k, 1], texts[k, 0]), None, base) for k in (0, 1)]
    found: list[tuple[float, list[int]]] = []
    for k in (0, 1):
        held = rows.where(fold == 1 - k).select("id", "text", F.col("y").cast("int").alias("y"))
        found += _histograms(folds[k], held)  # at most 2 x SAMPLE_ROWS small rows
    model = Model(*train_dictionaries(texts[0, 1] + texts[1, 1], texts[0, 0] + texts[1, 0]), None, base)
    found.sort()  # the fit does not depend on row order
    y = np.array([f[0] for f in found], dtype=float)
    if 0 < y.sum() < len(y):
        model.weights = _logistic(design(np.array([f[1] for f in found], dtype=float)), y)
    return model


def _histograms(model: Model, held: DataFrame) -> list[tuple[float, list[int]]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = _windows(model)
        for batch in batches:
            found = [windows.histogram(lower_words_of(t.as_py())).tolist() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), pa.array(found, pa.list_(pa.int64()))], names=["y", "kinds"])

    return [(r["y"], r["kinds"]) for r in held.mapInArrow(run, "y int, kinds array<bigint>").collect()]


def scores(model: Model, texts: list[str | None]) -> np.ndarray:
    """Score of every whole text, 0 to 1; null and empty texts are scored as texts without windows."""
    if model.weights is None:
        return np.full(len(texts), model.base)
    windows = _windows(model)
    if not texts:
        return np.zeros(0)
    return _sigmoid(design(np.array([windows.histogram(lower_words_of(t)) for t in texts], dtype=float)) @ model.weights)


def score_documents(model: Model, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted), one row per input row; ids may be null or repeated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = scores(model, batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                names=["id", "score", "predicted"])

    kind = docs.schema[id_col].dataType.simpleString()
    return scan_texts(docs, [id_col, text_col], run, f"id {kind}, score double, predicted int")


def drop_toxic(model: Model, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, all columns as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores(model, batch.column(at).to_pylist()) < 0.5))

    return docs.mapInArrow(run, docs.schema)


def op7_query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, labels)
    return score_documents(model, docs).select(
        F.col("id").alias("doc_id"), (remainder_of_id("id", 5) == 0).alias("held_out"), "score", "predicted")

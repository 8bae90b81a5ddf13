"""SentencePiece encoding and decoding with N-best segmentation over the piece lattice.

A text, spaces written as the space mark and one mark in front, is a lattice
whose edges are the vocabulary's pieces with their scores; a character that
no piece covers is an edge of byte pieces (10 under the lowest score). The score of a segmentation is the sum over its edges.

* Forward Viterbi gives the best score of every lattice node.
* Backward A* pops hypotheses from the end; the forward score of a node is
  the exact rest cost, so hypotheses complete in score order.

No piece crosses from a character into a following space mark, nor holds a
line feed, so the lattice falls into units (a word with the marks before
it), whose paths combine freely. Every unit's best path and the gap to its second path come from the
forward pass, once per distinct unit and worker. In the n best paths of a
text only the n - 1 units of smallest gap can leave their best path (single
changes at those units already make n paths as good), so A* runs there and
the paths are merged by score. A vocabulary without this property is searched
as one unit.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import scan_texts
from panelcast.llm.vocabulary import PIECE_MODEL, Vocabulary
from panelcast.worker import WorkerCache

MARK = "▁"
NEG = float("-inf")
UNKNOWN_PENALTY = 10.0
CACHE_UNITS = 1_000_000
CACHE_PATHS = 50_000
DEFAULT_N = 4

_UNITS = re.compile(rf"\n|{MARK}|[ ]*[^ \n{MARK}]+|[ ]+")


def _frozen(following: dict) -> dict:
    """The same pieces with tuples for lists and None where no longer piece follows."""
    return {c: (score, ids, _frozen(after) or None) for c, (score, ids, after) in following.items()}


class Lattice:
    """Paths through the pieces of a vocabulary."""

    def __init__(self, vocabulary: Vocabulary):
        p = vocabulary.processor
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte_ids = vocabulary.byte_ids
        self.spelling: list[bytes] = []
        for i in range(p.get_piece_size()):
            piece = p.id_to_piece(i)
            plain = not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i) or p.is_unused(i))
            if plain:
                self.score[piece], self.id[piece] = p.get_score(i), i
            self.spelling.append(
                bytes([int(piece[3:5], 16)]) if p.is_byte(i) else piece.replace(MARK, " ").encode() if plain else b"")
        self.unknown_id = p.unk_id()
        # runs of space marks are no measure of a rare piece: some vocabularies score them out of reach
        self.unknown_score = min((s for x, s in self.score.items() if x.strip(MARK)), default=0.0) - UNKNOWN_PENALTY
        # pieces by their characters: character -> (score or None, ids, the same for the next character or None)
        following: dict = {}
        for piece in self.score:
            at = following
            for c in piece:
                at = at.setdefault(c, [None, None, {}])[2]
        for piece in self.score:
            at = following
            for c in piece[:-1]:
                at = at[c][2]
            if piece:
                at[piece[-1]][:2] = self.score[piece], [self.id[piece]]
        self.first = _frozen(following)
        self.longest = max(map(len, self.score), default=1)
        self.splits = not any("\n" in x or MARK in x.lstrip(MARK) for x in self.score)

    def forward(self, unit: str) -> tuple[list[float], list[int], float, list[list[int]]]:
        """Best score of every node, the start of its best last edge, the second-best score of the whole unit, the edges' ids."""
        n, first = len(unit), self.first.get
        best, second, back = [0.0] + [NEG] * n, [NEG] * (n + 1), [0] * (n + 1)
        edges: list = [None] * (n + 1)  # None: an edge of byte pieces
        for i in range(n):
            here, next_here = best[i], second[i]
            found, j = first(unit[i]), i + 1
            if found is None or found[0] is None:  # a character without a piece of its own
                v = here + self.unknown_score
                if v > best[j]:
                    second[j] = max(best[j], second[j], next_here + self.unknown_score)
                    best[j], back[j], edges[j] = v, i, None
                elif v > second[j]:
                    second[j] = v
            while found is not None:
                s, ids, after = found
                if s is not None:
                    v, b = here + s, best[j]
                    if v > b:
                        w = next_here + s
                        if b > w:
                            w = b
                        if w > second[j]:
                            second[j] = w
                        best[j], back[j], edges[j] = v, i, ids
                    elif v > second[j]:
                        second[j] = v
                if after is None or j == n:
                    break
                found = after.get(unit[j])
                j += 1
        return best, back, second[n], edges

    def edge_ids(self, piece: str) -> list[int]:
        if piece in self.id:
            return [self.id[piece]]
        found = [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")]
        return [self.unknown_id] if -1 in found else found

    def best_path(self, unit: str) -> tuple[float, list[int], float]:
        """(score, ids, score of the second path or -inf)."""
        best, back, second, edges = self.forward(unit)
        path, j = [], len(unit)
        while j > 0:
            i = back[j]
            path.append(edges[j] or self.edge_ids(unit[i:j]))
            j = i
        path.reverse()
        return best[-1], list(chain.from_iterable(path)), second

    def n_best(self, unit: str, n: int) -> list[tuple[float, list[int]]]:
        """The n best paths of a unit by backward A*, best first.

        Of equal estimates the hypothesis nearest to the unit's start goes
        first, and a node is left after n pops: estimates are exact, so its later ones are
        not among the n best. So at most n hypotheses per node are extended, ties or not.
        """
        best, _, _, _ = self.forward(unit)
        heap: list = [(-best[-1], len(unit), 0, 0.0, None)]
        count, out, popped = 1, [], [0] * (len(unit) + 1)
        while heap and len(out) < n:
            _, j, _, done, path = heappop(heap)
            popped[j] += 1
            if popped[j] > n:
                continue
            if j == 0:
                ids: list[int] = []
                while path is not None:
                    piece, path = path
                    ids += self.edge_ids(piece)
                out.append((done, ids))
                continue
            for i in range(max(0, j - self.longest), j):
                piece = unit[i:j]
                s = self.score.get(piece)
                if s is None:
                    if j - i > 1 or piece in self.score:
                        continue
                    s = self.unknown_score
                if best[i] > NEG and popped[i] < n:
                    heappush(heap, (-(best[i] + s + done), i, count, s + done, (piece, path)))
                    count += 1
        return out

    def units(self, text: str) -> list[str]:
        """The text's units; a literal space mark is a unit of its own that is spelt in bytes."""
        if not text:
            return []
        if not self.splits:
            return [(" " + text).replace(MARK, "\0").replace(" ", MARK)]
        return _UNITS.findall(" " + text)

    def spelt(self, unit: str) -> str:
        """A unit as the lattice sees it."""
        return "\0" if unit == MARK else unit.replace(" ", MARK)

    def decode(self, ids) -> str:
        """Text of piece ids: the exact inverse of encoding for every text that UTF-8 can hold."""
        raw = b"".join(map(self.spelling.__getitem__, ids))
        return raw[1:].decode("utf-8", "replace") if raw[:1] == b" " else raw.decode("utf-8", "replace")


class UnitTable:
    """Best paths of the units seen by a worker (bounded; between texts the units seen in one text only are dropped)."""

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.numbers: dict[str, int] = {}
        self.ids: list[bytes] = []
        self.best, self.gap, self.length, self.texts = array("d"), array("d"), array("l"), np.zeros(1024, dtype=np.int32)
        self.names: list[str] = []
        self.alternatives: dict[tuple[str, int], list] = {}

    def _shrink(self):
        kept = np.nonzero(self.texts[:len(self.ids)] > 1)[0]
        kept = kept if len(kept) < CACHE_UNITS // 2 else kept[np.argsort(-self.texts[kept], kind="stable")][:CACHE_UNITS // 2]
        at = kept.tolist()
        self.names, self.ids = [self.names[i] for i in at], [self.ids[i] for i in at]
        self.best, self.gap = array("d", [self.best[i] for i in at]), array("d", [self.gap[i] for i in at])
        self.length = array("l", [self.length[i] for i in at])
        self.numbers = {u: i for i, u in enumerate(self.names)}
        self.texts[:len(at)] = self.texts[kept]
        self.texts[len(at):] = 0
        if len(self.alternatives) > CACHE_PATHS:
            self.alternatives.clear()

    def numbers_of(self, units: list[str]) -> np.ndarray:
        if len(self.ids) > CACHE_UNITS:
            self._shrink()
        numbers = self.numbers
        for u in set(units).difference(numbers):
            numbers[u] = len(self.ids)
            score, ids, second = self._path(u)
            self.ids.append(array("i", ids).tobytes())
            self.names.append(u)
            self.best.append(score)
            self.gap.append(score - second)
            self.length.append(len(ids))
        out = np.fromiter(map(numbers.__getitem__, units), dtype=np.int64, count=len(units))
        if len(self.texts) < len(self.ids):
            self.texts = np.concatenate([self.texts, np.zeros(len(self.ids), dtype=np.int32)])
        self.texts[out] += 1  # once per text
        return out

    def _path(self, unit: str) -> tuple[float, list[int], float]:
        if unit == MARK:  # a literal mark: bytes only
            return self.lattice.unknown_score, self.lattice.edge_ids("▁\0")[:3], NEG
        return self.lattice.best_path(self.lattice.spelt(unit))

    def paths_of(self, number: int, n: int) -> list[tuple[float, list[int]]]:
        key = (self.names[number], n)
        if key not in self.alternatives:
            self.alternatives[key] = self.lattice.n_best(self.lattice.spelt(self.names[number]), n)
        return self.alternatives[key]


_TABLES = WorkerCache("unit tables", keep=2)


def unit_table(vocabulary: Vocabulary) -> UnitTable:
    """The worker's table: units are solved once for all tasks of a Python process."""
    return _TABLES.get(vocabulary.key, lambda: UnitTable(Lattice(vocabulary)))


def encode_text(text: str | None, table: UnitTable, n: int) -> tuple[np.ndarray, list[tuple[float, list[tuple[int, int, list[int]]]]]]:
    """(ids of the best path, the n best paths as (score, changes)).

    A change (at, length, ids) replaces ``length`` ids of the best path from
    position ``at``; the first path has no changes.
    """
    numbers = table.numbers_of(table.lattice.units(text or ""))
    ids = np.frombuffer(b"".join(map(table.ids.__getitem__, numbers.tolist())), dtype=np.int32)
    total = float(np.frombuffer(table.best, dtype=np.float64)[numbers].sum()) if len(numbers) else 0.0
    paths: list[tuple[float, list]] = [(0.0, [])]
    if n > 1 and len(numbers):
        gaps = np.frombuffer(table.gap, dtype=np.float64)[numbers]
        near = np.argsort(gaps, kind="stable")[:n - 1] if len(gaps) < 4 * n else _smallest(gaps, n - 1)
        near = np.sort(near[np.isfinite(gaps[near])])
        if len(near):
            lengths = np.frombuffer(table.length, dtype=np.int64)[numbers]
            starts = np.cumsum(lengths) - lengths
            for u in near.tolist():
                ways = table.paths_of(int(numbers[u]), n)
                loss = [ways[0][0] - score for score, _ in ways]
                merged = [(cost + loss[k], changes + ([] if k == 0 else [(int(starts[u]), int(lengths[u]), ways[k][1])]))
                          for cost, changes in paths for k in range(len(ways))]
                merged.sort(key=lambda x: x[0])
                paths = merged[:n]
    return ids, [(total - cost, changes) for cost, changes in paths]


def _smallest(gaps: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k smallest values, the earlier ones among equals."""
    limit = np.partition(gaps, k - 1)[k - 1]
    under = np.nonzero(gaps < limit)[0]
    return np.concatenate([under, np.nonzero(gaps == limit)[0][:k - len(under)]])


ENCODED = ("ids array<int>, scores array<double>, "
           "alternatives array<array<struct<at: int, length: int, ids: array<int>>>>, decoded_equal boolean")


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = DEFAULT_N,
           model_path: str = PIECE_MODEL, other: tuple[str, ...] = ()) -> DataFrame:
    """(id, ``other`` columns, ids, scores, alternatives, decoded_equal), one row per input row.

    ``scores`` are those of the n best segmentations, best first (fewer if the
    lattice has fewer); ``alternatives[k]`` are the changes that turn the best path
    into the k-th. Of equal scores the path whose last pieces are found first comes first. ``decoded_equal``:
    decoding ``ids`` gives the text back. Null and empty texts have no ids and one segmentation of score 0.
    """
    vocabulary = Vocabulary.load(model_path)
    change = pa.struct([("at", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = unit_table(vocabulary)
        for batch in batches:
            ids, scores, changes, equal = [], [], [], []
            for t in batch.column(1):
                text = t.as_py()
                best, paths = encode_text(text, table, n)
                ids.append(best)
                scores.append([p[0] for p in paths])
                changes.append([[{"at": a, "length": m, "ids": x} for a, m, x in p[1]] for p in paths])
                equal.append(table.lattice.decode(best.tolist()) == (text or ""))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids) if ids else np.zeros(0, np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[batch.column(i + 2) for i in range(len(other))],
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                 pa.array(scores, pa.list_(pa.float64())), pa.array(changes, pa.list_(pa.list_(change))),
                 pa.array(equal, pa.bool_())],
                names=["id", *other, "ids", "scores", "alternatives", "decoded_equal"])

    kind = {f.name: f.dataType.simpleString() for f in df.schema}
    schema = ", ".join([f"id {kind[id_col]}", *[f"`{c}` {kind[c]}" for c in other], ENCODED])
    return scan_texts(df, [id_col, text_col, *other], run, schema)


def decode(df: DataFrame, id_col: str = "id", ids_col: str = "ids", model_path: str = PIECE_MODEL) -> DataFrame:
    """(id, text) of piece ids; null ids give a null text."""
    vocabulary = Vocabulary.load(model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = unit_table(vocabulary).lattice
        for batch in batches:
            texts = [None if x is None else lattice.decode(x) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return scan_texts(df, [id_col, ids_col], run, f"id {df.schema[id_col].dataType.simpleString()}, text string")


def path_ids(best: list[int], changes: list) -> list[int]:
    """The ids of an alternative path from the best path and its changes."""
    out = list(best)
    for at, length, ids in sorted(((c["at"], c["length"], c["ids"]) for c in changes), reverse=True):
        out[at:at + length] = ids
    return out


def op8_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return encode(docs).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("bigint").alias("n_tokens"), "ids",
        F.element_at("scores", 1).alias("best_score"), "scores", F.size("scores").alias("n_paths"), "alternatives", "decoded_equal")

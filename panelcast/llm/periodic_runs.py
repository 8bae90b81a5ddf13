"""Periodic runs of words by string synchronising sets.

A run is a maximal stretch with smallest period q and at least 4 * q words
(and ``LEAST`` words). Over the word numbers of a text:

* Scale t (8, 16, 32, ...) answers for periods in [t, 2t). Windows of t words
  are named by hashes, doubled from scale to scale. Position i belongs to the
  synchronising set if the least name among the windows starting at i .. i+t is
  that of i or of i+t. Membership depends on the 2t words from i only, so
  positions of equal context are chosen alike, and of any t neighbours one is
  chosen unless the text around is highly periodic.
* Consecutive chosen positions with equal 2t-word contexts at distance q in
  [t, 2t) propose the period q. In a run of period q this pair exists: a
  position of its first t words is chosen, so is the one q further on, and no
  equal context lies between them, since it would give the run a smaller period.
* Highly periodic regions, windows of t words with a period of at most t/4,
  are left out of the sets. They lie in runs found at smaller scales, and the
  periods below 8, which no scale answers for, are detected by comparing the
  text with itself at shifts 1 to 7.

A proposal is extended to its maximal stretch word by word, so hashes only
nominate. Texts of an Arrow batch are worked off together, with a number of its own
between any two of them.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import scan_texts, words_of

LEAST = 6
TIMES = 4
BASE = 8  # periods below are compared directly
FLUSH = 300_000  # words held before a block is worked off; a longer text is a block of its own

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xBF58476D1CE4E5B9)


def _name(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Names of two neighbouring windows together."""
    x = left * _M1 ^ (right * _M2 + _M3)
    x = (x ^ (x >> np.uint64(31))) * _M3
    return x ^ (x >> np.uint64(29))


def _doubled(names: np.ndarray, t: int) -> np.ndarray:
    """Names of 2t words from those of t words; fewer windows fit."""
    return _name(names[:-t], names[t:])


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    out, held = values, 1
    while 2 * held <= width:
        out = np.minimum(out[:-held], out[held:])
        held *= 2
    rest = width - held
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def synchronising_set(names: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """Positions chosen at scale t; windows marked ``periodic`` are never the least."""
    ranked = np.where(periodic, np.uint64(2**64 - 1), names)
    least = _least_of(ranked, t + 1)
    here, there = ranked[:len(least)], ranked[t:t + len(least)]
    return np.nonzero((least < np.uint64(2**64 - 1)) & ((here == least) | (there == least)))[0]


def _stretches(equal: np.ndarray, at_least: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the maximal stretches of True of at least that many."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], equal, [False]]).astype(np.int8)))
    start, end = edges[::2], edges[1::2]
    long = end - start >= at_least
    return start[long], end[long]


def _extend(x: np.ndarray, at: int, q: int, known: int) -> tuple[int, int]:
    """The maximal stretch of period q around x[at : at + known + q], whose words are known to have it."""
    end, step = at + known + q, 64
    while end < len(x):
        same = x[end:end + step] == x[end - q:end - q + min(step, len(x) - end)]
        if not same.all():
            end += int(np.argmin(same))
            break
        end += len(same)
        step *= 2
    start, step = at, 64
    while start > 0:
        low = max(0, start - step)
        same = x[low:start] == x[low + q:start + q]
        if not same.all():
            start = low + int(np.flatnonzero(~same)[-1]) + 1
            break
        start = low
        step *= 2
    return start, end


def _smaller_period(x: np.ndarray, start: int, q: int) -> bool:
    """Whether one turn of a stretch of period q repeats a shorter one that divides it."""
    turn = x[start:start + q]
    return any(q % p == 0 and np.array_equal(turn[p:], turn[:-p]) for p in range(1, q // 2 + 1))


def find_runs(x: np.ndarray, longest: int) -> np.ndarray:
    """(start, length, period) rows of the runs of ``x``, by start, then period; texts in it are no longer than ``longest``."""
    found: list[tuple[int, int, int]] = []
    covered: list[tuple[int, int, int]] = []  # (period, start, end) of all found runs
    for q in range(1, BASE):
        if len(x) <= q:
            break
        for a, b in zip(*(v.tolist() for v in _stretches(x[q:] == x[:-q], max(LEAST - q, (TIMES - 1) * q)))):
            if not _smaller_period(x, a, q):
                found.append((a, b + q - a, q))
                covered.append((q, a, b + q))
    names = _name(x.astype(np.uint64), np.uint64(0) * x.astype(np.uint64))
    for t in (1, 2, 4):
        names = _doubled(names, t) if len(names) > t else names[:0]
    t = BASE
    while TIMES * t <= longest and len(names) > t:
        context = _doubled(names, t)
        marks = np.zeros(len(names) + 1, dtype=np.int64)
        for q, a, b in covered:
            if TIMES * q <= t <= b - a:
                marks[a] += 1
                marks[b - t + 1] -= 1
        chosen = synchronising_set(names, t, np.cumsum(marks[:-1]) > 0)
        chosen = chosen[chosen < len(context)]
        order = np.argsort(context[chosen], kind="stable")
        here, key = chosen[order], context[chosen][order]
        apart = here[1:] - here[:-1]
        near = (key[1:] == key[:-1]) & (apart >= t) & (apart < 2 * t)
        at, period = here[:-1][near], apart[near]
        order = np.lexsort((at, period))
        at, period = at[order], period[order]
        first = np.ones(len(at), dtype=bool)  # a proposal within the last one's words extends to the same stretch
        first[1:] = (period[1:] != period[:-1]) | (at[1:] - at[:-1] >= 2 * t)
        last_end, last_q = -1, 0
        for a, q in zip(at[first].tolist(), period[first].tolist()):
            if q == last_q and a + 2 * t <= last_end:
                continue
            if not np.array_equal(x[a:a + 2 * t], x[a + q:a + q + 2 * t]):
                continue  # equal names of unequal words
            start, end = _extend(x, a, q, 2 * t)
            last_end, last_q = end, q
            if end - start >= TIMES * q and not _smaller_period(x, start, q):
                found.append((start, end - start, q))
                covered.append((q, start, end))
        names = context
        t *= 2
    out = np.array(found, dtype=np.int64).reshape(-1, 3)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def repeat_tail(words: list[bytes], doc_id) -> list[bytes]:
    """The words, for every tenth id (by crc32 of its decimal form) with a tail that repeats; a null id has none."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    turn = words[a:a + p]
    return words[:a] + (turn * (-(-(n - a) // len(turn))))[:n - a]


def _dropped(runs: np.ndarray, n: int) -> np.ndarray:
    """Words that a run contains after its first turn."""
    marks = np.zeros(n + 1, dtype=np.int64)
    for start, length, q in runs.tolist():
        marks[start + q] += 1
        marks[start + length] -= 1
    return np.cumsum(marks[:-1]) > 0


def runs_of_texts(texts: list[list[bytes]]) -> list[np.ndarray]:
    """Runs per text, starts counted from the text's first word."""
    numbers: dict[bytes, int] = {}
    parts, own, place, starts = [], -1, 0, []
    for words in texts:
        starts.append(place)
        parts.append(np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int64, count=len(words)))
        parts.append(np.array([own], dtype=np.int64))  # a separator equals nothing else
        own -= 1
        place += len(words) + 1
    x = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    runs = find_runs(x, max(map(len, texts), default=0))
    cut = np.searchsorted(runs[:, 0], np.array(starts + [place]))
    return [runs[a:b] - np.array([s, 0, 0]) for a, b, s in zip(cut[:-1], cut[1:], starts)]


SCHEMA = ("n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, "
          "collapsed_sha256 string, n_words bigint, n_dropped bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>")


def _row(words: list[bytes], runs: np.ndarray) -> tuple:
    listed = runs.tolist()
    best = min(listed, key=lambda r: (-r[1], r[0], r[2])) if listed else None
    drop = _dropped(runs, len(words))
    kept = [w for w, d in zip(words, drop.tolist()) if not d] if listed else words
    text = "".join(f"{s},{m},{q}\n" for s, m, q in listed).encode()
    return (len(listed), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, hashlib.sha256(text).hexdigest(),
            hashlib.sha256(b" ".join(kept)).hexdigest(), len(words), len(words) - len(kept),
            [{"start": s, "length": m, "period": q} for s, m, q in listed])


def periodic_runs(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted_tails: bool = False) -> DataFrame:
    """(id, n_runs, the longest run, digests, all runs), one row per input row.

    ``planted_tails`` gives every tenth id a repeating tail first
    (``repeat_tail``). Null, empty and wordless texts have no runs; of runs of equal
    length the one with the smallest start, then period, is reported. Rows are judged each
    on its own, so repeated rows repeat their result.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.int64()] * 2 + [turn]
        names = [c.split()[0] for c in SCHEMA.split(", ")[:9]] + ["runs"]
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            held, words, a = [], 0, 0
            for i in range(len(ids)):
                w = words_of(texts[i].as_py())
                held.append(repeat_tail(w, ids[i].as_py()) if planted_tails else w)
                words += len(w)
                if words > FLUSH or i == len(ids) - 1:
                    got = list(zip(*map(_row, held, runs_of_texts(held))))
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(a, len(held))] + [pa.array(g, k) for g, k in zip(got, kinds)], names=["id", *names])
                    held, words, a = [], 0, i + 1

    kind = df.schema[id_col].dataType.simpleString()
    return scan_texts(df, [id_col, text_col], run, f"id {kind}, {SCHEMA}")


def op13_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return periodic_runs(docs, planted_tails=True).select(
        F.col("id").alias("doc_id"), "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")

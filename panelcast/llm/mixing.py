"""Soft-membership mixing to target weights.

1. A multinomial logistic classifier, fitted on a bounded sample of the
   labelled table, gives every document its domain posteriors from its whole
   text (hashed word shares and byte shares).
2. Nonnegative document rates r minimise 1/2 (m - t)' A^-1 (m - t), where
   m = sum_d w_d r_d p_d are the expected domain token totals (w: token
   shares, p: posteriors), t the targets and A = sum_d w_d p_d p_d'. They are
   found by distributed projected gradient: starting from rates of 1, a step
   is r = max(0, y - p_d' s) with s = A^-1 (m(y) - t) and y the last rates with
   momentum (begun anew whenever the objective rises); in the metric A the step length 1 is
   the right one. A pass sums the totals over all documents; rates never leave
   the executors, since a task replays the few steps from p. Passes end when the totals are
   within TOLERANCE of the targets.
3. If GRADIENT_PASSES passes do not get there (targets nearly or wholly out of
   reach), the rates nearest to 1 that reach the least objective follow from
   r = max(0, 1 - p_d' v) for one K-vector v of prices, found by Newton steps on
   the K-dimensional dual, again one pass each, until the totals are met or the optimality condition shows
   that no nonnegative rates come nearer; the reached totals are returned and a miss is a warning.
"""

from __future__ import annotations

import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcast.llm.common import lower_words_of, materialise, scan_texts
from panelcast.worker import WorkerCache

WORD_BUCKETS = 1024
DIMENSIONS = WORD_BUCKETS + 256 + 1
SAMPLE_ROWS = 2_000  # labelled rows per domain that the classifier is fitted on, picked by id hash
CACHE_WORDS = 1_000_000
TOLERANCE = 1e-5  # L1 distance of the totals from the targets, as shares of all tokens
PULLS = (1e-2, 1e-4, 1e-6, 1e-8, 1e-10)  # weights of the distance of the rates from 1, each solved from the one before
STEPS = 0.5 ** np.arange(16)  # lengths tried in one pass
GRADIENT_PASSES = 60
MAX_PASSES = 400  # an error, not an end, for the Newton steps
DOMAINS = ("good", "poor", "toxic")
TARGETS = {"good": 0.90, "poor": 0.08, "toxic": 0.02}


def label_domain() -> Column:
    """Domain of a row of the labelled table (quality, toxic); rows with a null label have none."""
    return F.when(F.col("toxic") == 1, "toxic").when((F.col("toxic") == 0) & (F.col("quality") == 1), "good").when(
        (F.col("toxic") == 0) & (F.col("quality") == 0), "poor")


_TABLES = WorkerCache("word buckets", keep=1)


def features(text: str | None) -> tuple[np.ndarray, int]:
    """(features of the whole text, its number of words)."""
    words, known = lower_words_of(text), _TABLES.get(WORD_BUCKETS, dict)
    if len(known) > CACHE_WORDS:
        known.clear()
    for w in set(words):
        if w not in known:
            known[w] = zlib.crc32(w) % WORD_BUCKETS
    out = np.zeros(DIMENSIONS, dtype=np.float32)
    out[-1] = 1.0
    if words:
        hashed = np.bincount(np.array([known[w] for w in words]), minlength=WORD_BUCKETS) / len(words)
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        out[:WORD_BUCKETS] = np.sqrt(hashed)
        out[WORD_BUCKETS:-1] = np.sqrt(np.bincount(data, minlength=256) / len(data))
    return out, len(words)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


@dataclass
class Classifier:
    """Weights (DIMENSIONS x domains); a domain without labelled rows has posterior 0."""

    domains: tuple[str, ...]
    weights: np.ndarray

    def posteriors(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(posteriors, word counts) of whole texts."""
        if not texts:
            return np.zeros((0, len(self.domains))), np.zeros(0, dtype=np.int64)
        found = [features(t) for t in texts]
        return softmax(np.array([f[0] for f in found]) @ self.weights), np.array([f[1] for f in found], dtype=np.int64)


def fit_classifier(docs: DataFrame, labels: DataFrame, domains: tuple[str, ...] = DOMAINS,
                   id_col: str = "doc_id", text_col: str = "text", domain: Column | None = None) -> Classifier:
    """At most SAMPLE_ROWS labelled rows per domain reach the driver, as DIMENSIONS floats each.

    The sample holds the domains evenly; the posteriors are put back to the
    shares that the domains have among all labelled rows of ``docs``.
    """
    ids = docs.select(F.col(f"`{id_col}`").alias("id")).where("id is not null")
    named = materialise(
        labels.select(F.col(id_col).alias("id"), (label_domain() if domain is None else domain).alias("domain"))
        .where(F.col("domain").isin(*domains)).join(ids, "id", "left_semi"), "labelled")
    share = {r["domain"]: r["count"] for r in named.groupBy("domain").count().collect()}
    picked = None
    for d in domains:
        some = named.where(F.col("domain") == d).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
        picked = some if picked is None else picked.union(some)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).join(
        F.broadcast(picked.dropDuplicates(["id"])), "id").select("domain", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([features(t.as_py())[0].tobytes() for t in batch.column(1)], pa.binary())],
                names=["domain", "x"])

    got = sorted((r["domain"], bytes(r["x"])) for r in rows.mapInArrow(run, "domain string, x binary").collect())
    if not got:
        flat = np.zeros((DIMENSIONS, len(domains)))
        return Classifier(tuple(domains), flat)
    x = np.array([np.frombuffer(g[1], dtype=np.float32) for g in got], dtype=np.float64)
    y = np.array([domains.index(g[0]) for g in got])
    weights = _fit_softmax(x, y, len(domains))
    for k, d in enumerate(domains):
        if share.get(d) and (y == k).any():
            weights[-1, k] += np.log(share[d] / sum(share.values())) - np.log((y == k).mean())
    return Classifier(tuple(domains), weights)


def _fit_softmax(x: np.ndarray, y: np.ndarray, k: int, steps: int = 200, ridge: float = 1e-4) -> np.ndarray:
    """Multinomial logistic regression by accelerated gradient; domains without rows get a weight of -30."""
    present = np.bincount(y, minlength=k) > 0
    hot = np.eye(k)[y]
    w, v = np.zeros((x.shape[1], k)), np.zeros((x.shape[1], k))
    rate = 1.0 / (0.5 * np.linalg.norm(x, 2) ** 2 / len(x) + ridge)
    for i in range(steps):
        p = softmax(np.where(present, x @ v, -1e9))
        new = v - rate * (x.T @ (p - hot) / len(x) + ridge * v)
        v = new + i / (i + 3.0) * (new - w)
        w = new
    w[-1, ~present] = -30.0
    return w


def posterior_table(docs: DataFrame, classifier: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, p array<double>), one row per input row; a null text is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, n = classifier.posteriors(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(p.tolist(), pa.list_(pa.float64()))], names=["id", "n_tokens", "p"])

    return scan_texts(docs, [id_col, text_col], run,
                      f"id {docs.schema[id_col].dataType.simpleString()}, n_tokens bigint, p array<double>")


def rates_of(p: np.ndarray, rule: np.ndarray) -> np.ndarray:
    """Rates of documents with posteriors ``p``. ``rule``: a vector of prices, or gradient steps (momentum, vector) as rows."""
    return np.maximum(0.0, 1.0 - p @ rule) if rule.ndim == 1 else _replayed(p, rule)[0]


def _replayed(p: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rates after the steps, rates before the last one)."""
    r = last = np.ones(len(p))
    for step in steps:
        r, last = np.maximum(0.0, r + step[0] * (r - last) - p @ step[1:]), r
    return r, last


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _sums(table: DataFrame, prices: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sum n r^2, sum n r p, sum n p p' where r > 0) for each row of ``prices``, in one distributed pass."""
    s, k = prices.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squares, m, curved = np.zeros(s), np.zeros((s, k)), np.zeros((s, k * k))
        for batch in batches:
            if batch.num_rows:
                n, p = batch.column(0).to_numpy(zero_copy_only=False).astype(float)[:, None], _matrix(batch.column(1))
                r = np.maximum(0.0, 1.0 - p @ prices.T)
                squares += (n * r * r).sum(axis=0)
                m += (n * r).T @ p
                curved += (n * (r > 0)).T @ (p[:, :, None] * p[:, None, :]).reshape(len(p), k * k)
        values = np.concatenate([squares, m.ravel(), curved.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(values)), pa.int32()), pa.array(values)], names=["i", "x"])

    got = table.select("n_tokens", "p").mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    values = np.zeros(s + s * k + s * k * k)
    for r in got:
        values[r["i"]] = r["x"]
    return values[:s], values[s:s + s * k].reshape(s, k), values[s + s * k:].reshape(s, k, k)


def _totals(table: DataFrame, steps: np.ndarray, momentum: float) -> np.ndarray:
    """(sum n r p, sum n y p) after the steps, y the rates with momentum, in one distributed pass."""
    k = steps.shape[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = np.zeros((2, k))
        for batch in batches:
            if batch.num_rows:
                n, p = batch.column(0).to_numpy(zero_copy_only=False).astype(float), _matrix(batch.column(1))
                r, last = _replayed(p, steps)
                m += np.stack([n * r, n * (r + momentum * (r - last))]) @ p
        yield pa.RecordBatch.from_arrays([pa.array(range(2 * k), pa.int32()), pa.array(m.ravel())], names=["i", "x"])

    out = np.zeros(2 * k)
    for r in table.select("n_tokens", "p").mapInArrow(run, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect():
        out[r["i"]] = r["x"]
    return out.reshape(2, k)


def _gradient_steps(table: DataFrame, inverse: np.ndarray, m: np.ndarray, t: np.ndarray, total: float):
    """(steps, totals) of the projected gradient, or None if the targets are not met after GRADIENT_PASSES."""
    steps, momentum, pace, y = np.zeros((0, len(t) + 1)), 0.0, 1.0, m
    value = (m - t) @ inverse @ (m - t)
    for _ in range(GRADIENT_PASSES):
        steps = np.vstack([steps, np.concatenate([[momentum], inverse @ (y - t)])])
        pace, before = (1 + np.sqrt(1 + 4 * pace * pace)) / 2, pace
        momentum = (before - 1) / pace
        m, y = _totals(table, steps, momentum) / total
        if np.abs(m - t).sum() <= TOLERANCE:
            return steps, m
        new = (m - t) @ inverse @ (m - t)
        if new > value:
            momentum, pace, y = 0.0, 1.0, m
        value = new
    return None


def fit_rates(table: DataFrame, targets: dict[str, float], domains: tuple[str, ...] = DOMAINS,
              factors: bool = False, budget: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rule for ``rates_of``, expected totals, targets), the last two as shares of all tokens.

    ``targets`` are weights that are scaled to the token total, or with
    ``factors`` multiples of each domain's present expected total, or with
    ``budget`` weights scaled so that the domain of the largest weight keeps its tokens, no other domain
    being wanted beyond what it has (so the weights hold wherever the tokens are there, and nothing is repeated to reach them).
    Targets that no nonnegative rates reach are met as closely as least
    squares can, up to the least of PULLS. An empty table gives rates of 1.
    """
    k = len(domains)
    squares, m, a = (x[0] for x in _sums(table, np.zeros((1, k))))
    total = float(squares)
    t = np.array([max(0.0, targets.get(d, 0.0)) for d in domains])
    if total == 0 or t.sum() == 0:
        return np.zeros(k), np.zeros(k), t
    if factors:
        t = t * m / total
    elif budget:
        t = np.minimum(t * m[t.argmax()] / t.max(), m) / total
    else:
        t = t / t.sum()
    # In coordinates z with prices = base @ z the metric A is the identity; directions that no document has are left out.
    size, axes = np.linalg.eigh(a / total)
    held = size > 1e-9 * size.max()
    base = axes[:, held] / np.sqrt(size[held])
    z, square, m, curved = np.zeros(held.sum()), 1.0, m / total, a / total
    if np.abs(m - t).sum() <= TOLERANCE:
        return np.zeros(k), m, t
    met = _gradient_steps(table, base @ base.T, m, t, total)
    if met is not None:
        return *met, t
    passes = 1
    for pull in PULLS:
        while np.abs(m - t).sum() > TOLERANCE:
            slope = base.T @ (t - m) + pull * z
            if np.linalg.norm(slope) <= 0.01 * TOLERANCE * min(1.0, pull * np.linalg.norm(z)):
                break  # the optimality condition holds for this pull
            if passes >= MAX_PASSES:
                raise RuntimeError(f"rates not fitted after {passes} passes: totals {m}, targets {t}")
            step = -np.linalg.solve(base.T @ curved @ base + pull * np.eye(len(z)), slope)
            tried = z + STEPS[:, None] * step
            squares, ms, curves = (x / total for x in _sums(table, tried @ base.T))
            passes += 1
            value = lambda q, x: q / 2 + x @ (base.T @ t) + pull / 2 * (x * x).sum(axis=-1)
            at = int(np.argmin(value(squares, tried)))
            if value(squares[at], tried[at]) >= value(square, z):
                if np.linalg.norm(slope) > TOLERANCE:
                    raise RuntimeError(f"rates not fitted: totals {m}, targets {t}, slope {slope}")
                break  # nothing lower within rounding
            z, square, m, curved = tried[at], squares[at], ms[at], curves[at]
    return base @ z, m, t


def _warn_of_miss(totals: np.ndarray, targets: np.ndarray, domains: tuple[str, ...]) -> None:
    if np.abs(totals - targets).sum() > TOLERANCE:
        warnings.warn("no nonnegative rates reach the targets; domain: reached of target, as shares of all tokens: " + ", ".join(
            f"{d}: {x:.6f} of {t:.6f}" for d, x, t in zip(domains, totals, targets)), stacklevel=3)


def mix_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS,
              domains: tuple[str, ...] = DOMAINS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, p_<domain>..., rate), one row per input row.

    Ids may be null or repeated (equal texts get equal rates); a text without words has
    no weight in the fit and the rate that its posteriors give.
    """
    classifier = fit_classifier(docs, labels, domains, id_col, text_col)
    table = materialise(posterior_table(docs, classifier, id_col, text_col), "posteriors")
    prices, totals, wanted = fit_rates(table, targets, domains)
    if totals.any():
        _warn_of_miss(totals, wanted, domains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch.column(2)) if batch.num_rows else np.zeros((0, len(domains)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *[pa.array(p[:, j]) for j in range(len(domains))],
                 pa.array(rates_of(p, prices))],
                names=["id", "n_tokens", *[f"p_{d}" for d in domains], "rate"])

    schema = f"id {table.schema['id'].dataType.simpleString()}, n_tokens bigint, " + "".join(
        f"p_{d} double, " for d in domains) + "rate double"
    return table.mapInArrow(run, schema)


def copies_of(rates: np.ndarray, ids: list) -> np.ndarray:
    """Whole copies whose expectation is the rate: the fraction is decided by a hash of the id."""
    whole = np.floor(rates)
    chance = np.array([zlib.crc32(b"mix:" + str(i).encode()) / 2**32 for i in ids])
    return (whole + (chance < rates - whole)).astype(np.int64)


def mix_documents(docs: DataFrame, labels: DataFrame, targets: dict[str, float], domains: tuple[str, ...] = DOMAINS,
                  factors: bool = False, budget: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` as many times as its rate says, all columns as they are.

    A fractional rate becomes whole copies by a hash of the id, so rows of one
    id and text stay or go together. Null texts count as empty ones, without weight in the fit; an empty frame stays empty.
    """
    classifier = fit_classifier(docs, labels, domains, id_col, text_col)
    table = materialise(posterior_table(docs, classifier, id_col, text_col), "posteriors")
    prices, totals, wanted = fit_rates(table, targets, domains, factors, budget)
    if totals.any():
        _warn_of_miss(totals, wanted, domains)
    at_id, at_text = docs.columns.index(id_col), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p, _ = classifier.posteriors(batch.column(at_text).to_pylist())
            copies = copies_of(rates_of(p, prices), batch.column(at_id).to_pylist())
            rows = np.repeat(np.arange(batch.num_rows), copies)
            for a in range(0, len(rows), 4096):
                yield batch.take(pa.array(rows[a:a + 4096]))

    return docs.mapInArrow(run, docs.schema)


def op1_query(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    return mix_rates(docs, labels).withColumnRenamed("id", "doc_id")

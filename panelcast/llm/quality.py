"""Quality rules from tokeniser fertility, with rejection bands per language.

Three figures of a public vocabulary per document, over its words (each
word tokenised with its leading space mark, white space itself left out):
characters per token, share of byte-fallback tokens, entropy of the tokens.
Prose of one language and length has them in narrow bands; junk, markup
residue and shouting fall outside.

The bands are Tukey fences (quartiles -/+ FENCE x interquartile range) of all
distinct texts that pass the base rules, per language and length class (powers
of two of the word count), from exact histograms of the rounded figures. Each
text counts once in its language however many copies it has, and the
interquartile range counts as no less than MIN_IQR of the median (more in the
classes of short texts), since near copies can still make quartiles coincide.
The fences of a small group are drawn towards those of the next wider one
(class, language, all languages) by as much as its texts are few; no size switches a rule on or off. The byte share
has an upper fence only, at least MIN_BYTE_FENCE.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from panelcast.llm.common import materialise, words_of
from panelcast.llm.vocabulary import PIECE_MODEL, Vocabulary
from panelcast.worker import WorkerCache

FENCE = 2.5
TRUST = 40  # texts of a group that weigh as much as the wider group
REACH = 8  # texts of a group that widen the wider group's band half the way to their own
MIN_BYTE_FENCE = 0.05
MIN_IQR = 0.02  # of the median: fences keep some width where quartiles coincide
SHORT_IQR = 0.3  # the same for a class of n words and more, divided by sqrt(n): short texts scatter more
CACHE_WORDS = 1_000_000
FLUSH = 1_000_000  # characters measured together
BROADCAST_BANDS = 20_000  # rows of about 100 bytes
SPACES, SYMBOLS = " \t\n\v\f\r", "#*$%&|<>"
FIGURES = ("chars_per_token", "byte_share", "token_entropy")
SCALE = 1000  # figures are rounded to 1/SCALE in the histograms

SCHEMA = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "n_tokens bigint, chars_per_token double, byte_share double, token_entropy double")


class WordTable:
    """Numbers and token ids of the words seen by a worker (bounded; cleared between batches of documents).

    The ids of all words lie in one flat array, so a batch's ids are gathered
    by position and no object is made per word.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.encode = vocabulary.processor.encode
        self.is_byte = np.zeros(vocabulary.processor.get_piece_size(), dtype=bool)
        self.is_byte[[i for i in vocabulary.byte_ids if i >= 0]] = True
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.ids, self.ends = array("i"), array("q", [0])

    def numbers_of(self, words: list[bytes]) -> np.ndarray:
        """A number per word; words not seen before are tokenised in one call."""
        numbers, ids, ends = self.numbers, self.ids, self.ends
        new = list(set(words).difference(numbers))
        if new:
            at = len(ends) - 1
            for found in self.encode([w.decode("utf-8", "replace") for w in new]):
                ids.extend(found)
                ends.append(len(ids))
            numbers.update(zip(new, range(at, at + len(new))))
        return np.fromiter(map(numbers.__getitem__, words), dtype=np.int64, count=len(words))

    def tokens_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of the words one after the other, tokens per word)."""
        ends = np.frombuffer(self.ends, dtype=np.int64)
        start = ends[numbers]
        held = ends[numbers + 1] - start
        place = np.arange(int(held.sum())) - np.repeat(np.cumsum(held) - held, held)
        return np.frombuffer(self.ids, dtype=np.int32)[np.repeat(start, held) + place] if len(place) else np.zeros(0, np.int32), held


_TABLES = WorkerCache("word tables", keep=2)


def _table(vocabulary: Vocabulary) -> WordTable:
    return _TABLES.get(vocabulary.key, lambda: WordTable(vocabulary))


def repeated_words(numbers: np.ndarray, width: int = 3) -> int:
    """Words inside a ``width``-word window that occurs twice or more, its first occurrence included."""
    n = len(numbers) - width + 1
    if n < 2:
        return 0
    bits = 63 // width
    if int(numbers.max()) >> bits:  # too many words to code a window in 63 bits as they are numbered: number them anew
        _, windows = np.unique(np.stack([numbers[i:i + n] for i in range(width)]), axis=1, return_inverse=True)
        windows = windows.ravel()
    else:
        windows = numbers[:n].copy()
        for i in range(1, width):
            windows = windows << bits | numbers[i:i + n]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    marked = np.zeros(len(numbers), dtype=bool)
    for i in range(width):
        marked[i:i + n] |= twice
    return int(marked.sum())


def measure(texts: list[str | None], table: WordTable) -> list[tuple]:
    """The base counts and the three figures of whole texts (null: an empty text)."""
    words = [words_of(t) for t in texts]
    if len(table.numbers) > CACHE_WORDS:
        table.clear()
    numbers = table.numbers_of([w for x in words for w in x])
    ids, held = table.tokens_of(numbers)
    by_word = np.concatenate([[0], np.cumsum(held)])
    out, at = [], 0
    for t, x in zip(texts, words):
        text, upto = t or "", at + len(x)
        mine = ids[by_word[at]:by_word[upto]]
        lines = [y for y in text.split("\n") if y.strip(SPACES)]
        chars = len(text) - sum(map(text.count, SPACES))
        if len(mine):
            counts = np.bincount(mine)
            counts = counts[counts > 0] if len(mine) > 4096 else np.unique(mine, return_counts=True)[1]
            share = counts / len(mine)
            figures = (chars / len(mine), float(table.is_byte[mine].mean()), float(-(share * np.log2(share)).sum()))
        else:
            figures = (None, None, None)
        out.append((len(x), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated_words(numbers[at:upto]),
                    len(mine), *figures))
        at = upto
    return out


def measures(df: DataFrame, id_col: str, text_col: str, lang_col: str, vocabulary: Vocabulary) -> DataFrame:
    """(id, lang, text_key, counts and figures), one row per input row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _table(vocabulary)
        kinds = [pa.int64()] * 6 + [pa.float64()] * 3
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for batch in batches:
            rows, held, size = [], [], 0
            for t in batch.column(3):
                held.append(t.as_py())
                size += len(held[-1] or "")
                if size > FLUSH:  # a longer text is measured alone
                    rows += measure(held, table)
                    held, size = [], 0
            got = list(zip(*(rows + measure(held, table)))) or [()] * 9
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(3)] + [pa.array(g, k) for g, k in zip(got, kinds)],
                names=["id", "lang", "text_key", *names])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{lang_col}`"), F.lit("")).alias("lang"),
        text_key(text_col).alias("text_key"), F.col(f"`{text_col}`").alias("text"),
    ).mapInArrow(run, f"id {kind}, lang string, text_key bigint, {SCHEMA}")


def text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def _length_class() -> Column:
    return F.floor(F.log2(F.greatest("n_words", F.lit(1)))).cast("int")


def _histogram(measured: DataFrame) -> DataFrame:
    """(lang, length_class, figure, bin, n); length_class -1 stands for all lengths."""
    figures = F.explode(F.map_from_arrays(
        F.array(*[F.lit(f) for f in FIGURES]), F.array(*[F.round(F.col(f) * SCALE).cast("int") for f in FIGURES])))
    return (
        measured.where("n_tokens > 0")
        .select("lang", F.explode(F.array(_length_class(), F.lit(-1))).alias("length_class"), *FIGURES)
        .select("lang", "length_class", figures.alias("figure", "bin"))
        .groupBy("lang", "length_class", "figure", "bin").agg(F.count(F.lit(1)).alias("n"))
    )


def _fences(hist: DataFrame, fence: float) -> DataFrame:
    """(lang, length_class, figure, total, low, high) from the exact quartiles of the rounded figures."""
    group = ["lang", "length_class", "figure"]
    hist = hist.withColumn("upto", F.sum("n").over(Window.partitionBy(*group).orderBy("bin"))).withColumn(
        "total", F.sum("n").over(Window.partitionBy(*group)))
    quartile = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.col("bin"))) / SCALE
    fences = hist.groupBy(*group).agg(
        F.max("total").alias("total"), quartile(0.25).alias("q1"), quartile(0.5).alias("q2"), quartile(0.75).alias("q3"))
    least = F.when(F.col("length_class") < 0, F.lit(MIN_IQR)).otherwise(
        F.greatest(F.lit(MIN_IQR), SHORT_IQR / F.sqrt(F.pow(F.lit(2.0), F.col("length_class")))))
    width = F.greatest(F.col("q3") - F.col("q1"), F.col("q2") * least) * fence
    share = F.col("figure") == "byte_share"
    return fences.select(
        *group, "total",
        F.when(share, F.lit(0.0)).otherwise(F.col("q1") - width).alias("low"),
        F.when(share, F.greatest(F.col("q3") + width, F.lit(MIN_BYTE_FENCE))).otherwise(F.col("q3") + width).alias("high"),
    )


def bands(measured: DataFrame, fence: float = FENCE, min_group: int = 1) -> DataFrame:
    """(lang, length_class, figure, low, high) from each group's own rows, of the groups with ``min_group`` rows; length_class -1
    stands for all lengths.

    The histograms are aggregated before the shuffle, their size follows the
    rounding, not the rows.
    """
    return _fences(_histogram(measured), fence).where(F.col("total") >= min_group).drop("total")


def _blended(own: DataFrame, wider: DataFrame, on: list[str]) -> DataFrame:
    """Fences of groups, each drawn towards those of the wider group by as much as its rows are few.

    With n rows a side lies at n / (n + TRUST) of its own place, for the rest at the outer one of both places,
    towards which the wider group's place moves by n^2 / (n^2 + REACH^2): few rows widen a band a little, many decide it.
    """
    n = F.col("total")
    trust, reach = n / (n + TRUST), n * n / (n * n + REACH**2)
    joined = own.join(wider.select(*on, F.col("low").alias("low_w"), F.col("high").alias("high_w")), on)
    side = lambda x, outer: trust * F.col(x) + (1 - trust) * (
        F.col(f"{x}_w") + reach * (outer(F.col(x), F.col(f"{x}_w")) - F.col(f"{x}_w")))
    return joined.select("lang", "length_class", "figure", side("low", F.least).alias("low"), side("high", F.greatest).alias("high"))


def _band_table(measured: DataFrame, fence: float) -> DataFrame:
    """Bands as a table of a size that is measured: (lang, length_class, figure, low, high)."""
    hist = materialise(_histogram(measured), "histogram")
    own = _fences(hist, fence)
    together = hist.where("length_class = -1").groupBy("length_class", "figure", "bin").agg(F.sum("n").alias("n"))
    every = _fences(together.withColumn("lang", F.lit("")), fence)  # one row per figure
    languages = materialise(_blended(own.where("length_class = -1"), every, ["figure"]), "languages")
    classes = _blended(own.where("length_class >= 0"), languages, ["lang", "figure"])
    return materialise(languages.union(classes), "bands")


def judge(measured: DataFrame, fence: float = FENCE) -> DataFrame:
    """``measured`` plus base_failed and kept.

    base_failed: fewer than 50 words, or over half of the words repeated.
    kept: not base_failed and every figure inside its band. Bands come from
    distinct texts. Null and empty texts fail the base rules; an empty frame
    gives an empty result.
    """
    base = measured.withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))
    texts = base.where("not base_failed").select("lang", "text_key", "n_words", "n_tokens", *FIGURES).dropDuplicates(
        ["lang", "text_key"])
    fenced = _band_table(texts, fence)
    sides = [f"{f}_{side}" for f in FIGURES for side in ("low", "high")]
    wide = fenced.groupBy("lang", "length_class").agg(*[
        F.max(F.when(F.col("figure") == f, F.col(side))).alias(f"{f}_{side}") for f in FIGURES for side in ("low", "high")])
    # every text that passed the base rules has the band of its own language and class
    small = fenced.count() <= BROADCAST_BANDS
    joined = base.withColumn("length_class", _length_class()).join(
        F.broadcast(wide) if small else wide, ["lang", "length_class"], "left")
    outside = F.lit(False)
    for f in FIGURES:
        outside |= F.coalesce((F.col(f) < F.col(f"{f}_low")) | (F.col(f) > F.col(f"{f}_high")), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~outside).drop("length_class", *sides)


def quality(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
            model_path: str = PIECE_MODEL) -> DataFrame:
    measured = materialise(measures(df, id_col, text_col, lang_col, Vocabulary.load(model_path)), "quality")
    return judge(measured)


def drop_rejected(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  model_path: str = PIECE_MODEL) -> DataFrame:
    """The rows of ``df`` that are kept, all columns as they are (equal id, text and language share one verdict)."""
    rejected = quality(df, id_col, text_col, lang_col, model_path).where("not kept").select(
        F.col("id").alias("__id"), F.col("text_key").alias("__key"), F.col("lang").alias("__lang")).distinct()
    return df.join(
        rejected,
        F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (text_key(text_col) == F.col("__key"))
        & (F.coalesce(F.col(f"`{lang_col}`"), F.lit("")) == F.col("__lang")), "left_anti")


def op5_query(spark: SparkSession, docs: DataFrame) -> DataFrame:
    return quality(docs).select(
        F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_tokens", *FIGURES)

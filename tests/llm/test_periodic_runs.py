"""Periodic runs against every shift of every text."""

import hashlib
import random
import re
import zlib

import numpy as np

from panelcast.llm import periodic_runs as P

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, start bigint, runs string"


def plain_runs(x):
    out = []
    for q in range(1, len(x) // 4 + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            n = j - i + q
            if j > i and n >= max(6, 4 * q) and not any(x[i:i + n - p] == x[i + p:i + n] for p in range(1, q)):
                out.append((i, n, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, planted):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(w), h // 10
    if planted and h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    gone = {k for s, m, q in runs for k in range(s + q, s + m)}
    sha = lambda t: hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def repetitive(rng):
    w = []
    for _ in range(rng.randint(0, 7)):
        turn = [f"{rng.randrange(rng.choice([2, 3, 60]))}" for _ in range(rng.choice([1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 24, 31, 33, 48]))]
        w += turn * rng.choice([1, 1, 2, 3, 4, 4, 5, 9, 20]) + turn[:rng.randrange(len(turn))]
    return w


def test_runs_equal_all_shifts():
    rng = random.Random(2)
    for _ in range(500):
        texts = [[w.encode() for w in repetitive(rng)] for _ in range(3)]
        for words, got in zip(texts, P.runs_of_texts(texts)):
            assert [tuple(r) for r in got.tolist()] == plain_runs(words)


def test_nested_repeats():
    """A long period whose turn holds highly periodic regions itself."""
    for inner, tail in ((1, 9), (2, 17), (3, 40), (5, 64), (7, 11)):
        turn = [str(k % inner) for k in range(inner * 12)] + [f"t{k}" for k in range(tail)]
        words = [w.encode() for w in ["a"] + turn * 6 + turn[:4] + ["b"]]
        assert [tuple(r) for r in P.runs_of_texts([words])[0].tolist()] == plain_runs(words)


def test_synchronising_set_is_consistent_and_dense():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 3, 4000)
    names = x.astype(np.uint64)
    for t in (1, 2, 4):
        names = P._doubled(names, t)
    chosen = P.synchronising_set(names, 8, np.zeros(len(names), dtype=bool))
    context, members = {}, set(chosen.tolist())
    for i in range(len(x) - 16):
        context.setdefault(x[i:i + 16].tobytes(), []).append(i in members)
    assert all(len(set(v)) == 1 for v in context.values())
    assert np.diff(chosen).max() <= 8


def test_query_equals_plain_rows(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(repetitive(rng))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "a"), (204, "a " * 5), (205, "a " * 6), (206, "ä\x85b ä\x85b " * 9), (None, "b " * 30),
             (None, None), (3, rows[3][1]), (3, rows[3][1]), (207, "x y " * 20 + "x x x x x x x " + "y x " * 4), (208, "long " * 30_000)]
    df = spark.createDataFrame([(*r, 1, "runs") for r in rows], SCHEMA)
    got = [tuple(r) for r in P.op13_query(spark, df).collect()]
    want = [plain_row(d, t if d != 208 else "long " * 40, True) for d, t in rows if d != 208]
    assert sorted(map(str, (r for r in got if r[0] != 208))) == sorted(map(str, want))
    assert [r[1:6] for r in got if r[0] == 208] == [(1, 0, 30_000, 1, 30_000_000)]
    every = {r["id"]: r for r in P.periodic_runs(df.where("doc_id < 150"), "doc_id", "text").collect()}
    for d, t in rows[:150]:
        w = (t or "").split()
        assert [(r["start"], r["length"], r["period"]) for r in every[d]["runs"]] == plain_runs(w)
        assert every[d]["n_words"] == len(w)


def test_nothing(spark):
    assert P.op13_query(spark, spark.createDataFrame([], SCHEMA)).count() == 0

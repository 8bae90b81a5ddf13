"""The n-gram Jaccard join against all pairs of plain Python sets."""

import random

import numpy as np
import pytest
import xxhash

from panelcast.llm import ngram_join as J

SCHEMA = "doc_id bigint, text string, n bigint, node int, buckets string"


def words_of(text):
    return bytes(text or "", "utf-8").lower().split()


def plain_set(text, width=3):
    w = words_of(text)
    return {b" ".join(w[i:i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()


def plain_components(rows, width, percent):
    sets = [plain_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    out = {}
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.setdefault((d, rows[i][1]), (len(sets[i]), min(ids, default=None) if sets[i] else d))
    return out


def compare(spark, rows, width=3, percent=90):
    df = spark.createDataFrame([(d, t, 1, 2, "x") for d, t in rows], SCHEMA).repartition(3)
    got = J.jaccard_join(df, "doc_id", "text", width, percent).collect()
    assert len(got) == len(rows)
    want = plain_components(rows, width, percent)
    assert sorted(map(str, [(r["id"], r["n_shingles"], r["component_id"]) for r in got])) == sorted(
        map(str, [(d, *want[d, t]) for d, t in rows]))
    return want


def varied(rng, base, changes):
    out = list(base)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return out


def test_families_chains_and_sizes(spark):
    rng = random.Random(4)
    rows = []
    for f in range(14):
        base = [f"b{f}x{rng.randrange(400)}" for _ in range(rng.choice([4, 11, 12, 20, 60, 150, 400]))]
        for _ in range(rng.randrange(2, 9)):
            step = varied(rng, base, rng.randrange(0, 1 + len(base) // 20))
            rows.append((len(rows), " ".join(step[:rng.randrange(len(step) * 9 // 10, len(step) + 1)])))
            if rng.random() < 0.3:
                base = step  # a chain: neighbours are linked, ends may not be
    rng.shuffle(rows)
    want = compare(spark, rows)
    assert 1 < len({c for _, c in want.values()}) < len(rows)


@pytest.mark.parametrize("width, percent", [(1, 70), (2, 75), (5, 80)])
def test_other_thresholds(spark, width, percent):
    rng = random.Random(percent)
    rows = []
    for f in range(8):
        base = [f"b{f}x{rng.randrange(60)}" for _ in range(rng.choice([3, 9, 30, 90]))]
        rows += [(len(rows) + k, " ".join(varied(rng, base, rng.randrange(0, 1 + len(base) // 6)))) for k in range(6)]
    compare(spark, rows, width, percent)


def test_large_group_of_near_copies_and_a_neighbour(spark):
    rng = random.Random(9)
    base = [f"c{i}" for i in range(130)]
    rows = [(i, " ".join(varied(rng, base, 1))) for i in range(400)]
    apart = base[:60] + [f"d{i}" for i in range(9)] + base[69:]  # near the family's edge, on either side
    rows += [(1000 + i, " ".join(varied(rng, apart, i % 4))) for i in range(20)]
    compare(spark, rows)


def test_pairs_of_a_large_group_grow_with_its_size(spark, monkeypatch):
    """Near copies, most too far apart for a link, that share their few new words: a copy is counted against few others."""
    counted = []
    monkeypatch.setattr(J, "_count", lambda pairs, *a, f=J._count: counted.append(pairs.count()) or f(pairs, *a))
    for copies in (200, 400):
        rng = random.Random(5)
        base, rows = [f"c{i}" for i in range(150)], []
        for i in range(copies):
            out = list(base)
            for _ in range(i % 7):
                out[rng.randrange(len(out))] = f"w{rng.randrange(3)}"
            rows.append((i, " ".join(out)))
        counted.clear()
        compare(spark, rows)
        assert sum(counted) <= 4 * copies, counted


def test_odd_rows(spark):
    text = "one two three four five six seven eight nine ten eleven twelve thirteen"
    rows = [(5, text), (6, text.upper()), (7, None), (8, ""), (9, " \n"), (10, "a b"), (4, "A  b"), (11, "b a"), (5, text), (5, "other words"),
            (None, text), (None, None), (None, "lonely text of nobody"), (20, "x " * 3000), (21, "x x x x"), (22, "é É"), (23, "x\x85y z")]
    compare(spark, rows)


def test_nothing(spark):
    assert J.jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0
    assert J.jaccard_join(spark.createDataFrame([(1, None, 1, 1, "")], SCHEMA)).first()["component_id"] == 1


def test_linked_sets_share_a_bucket():
    """Sets at the threshold agree in a segment, whatever their sizes, also where many segments are empty."""
    rng = np.random.default_rng(3)
    for percent in (70, 80, 90, 97):
        classes = J.SizeClasses(percent)
        for n in [1, 2, 5, 9, 10, 11, 19, 20, 33, 100, 257, 1000, 5000]:
            for _ in range(6):
                a = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))
                lost = rng.integers(0, n + 1)
                while True:  # as many changes as still leave a link
                    gained = rng.integers(0, lost + 1)
                    o = len(a) - lost
                    if 100 * o >= percent * (len(a) + gained):
                        break
                    lost -= 1
                b = np.unique(np.concatenate([a[lost:], rng.integers(0, 2**64, gained, dtype=np.uint64)]))
                if len(b) == 0 or np.array_equal(a, b):
                    continue
                x, y = J.signatures(np.concatenate([a, b]), np.array([len(a), len(b)]), classes)
                assert np.intersect1d(x, y).size, (percent, n, lost, gained)


def test_low_thresholds_are_refused():
    with pytest.raises(ValueError):
        J.SizeClasses(60)


def test_shingle_hash_is_xxh64():
    assert J.shingle_hashes("A b c d", 3) == [xxhash.xxh64_intdigest(s, 42) for s in (b"a b c", b"b c d")]

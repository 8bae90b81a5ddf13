"""Each training-data operator against a plain version of itself, with nulls, empty and long texts, ties,
repeated rows, empty tables and clashing column names."""

import collections
import heapq
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

from conftest import SF_SMALL
from panelcast.llm import (
    components, hamming_search, html, licenses, maxent_lm, mixing, pieces, quality, queries, sharding, simhash, toxicity)
from panelcast.llm.common import read_table
from panelcast.llm.vocabulary import Vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, shard int, id string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def odd_rows():
    """Nulls everywhere, empty and long texts, ties and repeated rows."""
    rng = random.Random(5)
    words = ["the", "of", "and", "haus", "été", "Ünter", "ab", "x", "tion", "ing"]
    prose = lambda n: " ".join(rng.choice(words) + rng.choice(["", "s", "ed"]) for _ in range(n))
    texts = [prose(80) for _ in range(30)] + [None, "", "  \n\t ", "one", "two words", "word " * 300, "a b\x85c d e f",
                                              "▁ mark\nline", prose(6000), "x" * 50_000, "☃ 漢字 " * 40]
    rows = [(i, t, ["en", "de", None][i % 3], "s", None, 1.0, 2, "c") for i, t in enumerate(texts)]
    return rows + [rows[3], rows[3], (None, texts[2], None, None, None, None, None, None), (None, None) + (None,) * 6,
                   (1000, texts[1], "en", "s", 1, 1.0, 1, "d")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return read_table(spark, SF_SMALL, "documents")


@pytest.fixture(scope="module")
def labels(spark):
    return read_table(spark, SF_SMALL, "labels")


# --- sharding

def test_feistel_is_a_permutation(spark):
    for n in (1, 2, 3, 7, 16, 97, 1000):
        rows = spark.range(n).withColumnRenamed("id", "row")
        got = [r[0] for r in sharding.feistel_position(rows, "row", "pos", n, 3).select("pos").collect()]
        assert sorted(got) == list(range(n))


def test_shards_are_even_and_gapless(odd):
    out = sharding.op10_query(odd.sparkSession, odd).collect()
    rows = odd_rows()
    assert collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == collections.Counter(
        (r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    by = collections.defaultdict(list)
    for r in out:
        by[r["shard"]].append(r["slot"])
    assert max(map(len, by.values())) - min(len(by.get(s, [])) for s in range(16)) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    again = sharding.op10_query(odd.sparkSession, odd.repartition(7)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))  # whatever the partitions


def test_large_group_of_copies_is_numbered(spark):
    many = spark.range(25_000).selectExpr("1L AS a", "2L AS b")
    out, n = sharding.number_rows(many, ["a", "b"], "row")
    assert n == 25_000 and out.select("row").distinct().count() == n


def test_sharding_of_nothing(empty):
    assert sharding.op10_query(empty.sparkSession, empty).count() == 0


# --- simhash

def plain_fingerprint(text, width=3):
    words = WORD.findall(lower(text))
    shingles = [" ".join(words[i:i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode("utf-8", "surrogatepass"), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def plain_components(values, radius=3):
    parent = list(range(len(values)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(values)), 2):
        if (values[i] ^ values[j]).bit_count() <= radius:
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def test_near_duplicates_equal_all_pairs(docs, odd):
    for df in (docs, odd):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        fps = [plain_fingerprint(t) for _, t in rows]
        root = plain_components(fps)
        least = {}
        for (i, _), k in zip(rows, root):
            if i is not None:
                least[k] = min(i, least.get(k, i))
        want = collections.Counter((i, format(f, "016x"), least.get(k)) for (i, _), f, k in zip(rows, fps, root))
        got = collections.Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.op9_query(df.sparkSession, df).collect())
        assert got == want
        kept = simhash.keep_one_per_group(df)
        assert kept.columns == df.columns and kept.count() == len(set(root))


@pytest.mark.parametrize("long_run", [4, 10_000])
def test_links_lose_no_component(spark, long_run):
    rng = random.Random(2)
    centre = rng.getrandbits(64)
    values = {centre}
    for _ in range(250):
        v = rng.choice(sorted(values))
        for b in rng.sample(range(64), rng.randint(1, 5)):
            v ^= 1 << b
        values.add(v)
    values = sorted(values)
    signed = [int(np.uint64(v).view(np.int64)) for v in values]
    found = components.connected_components(
        simhash.links(spark.createDataFrame([(s,) for s in signed], "fp bigint"), 3, long_run=long_run))
    root = {r["node"]: r["root"] for r in found.collect()}
    label = [root.get(s, s) for s in signed]
    want = plain_components(values)
    assert len(set(zip(label, want))) == len(set(label)) == len(set(want))


def test_near_duplicates_of_nothing(empty):
    assert simhash.op9_query(empty.sparkSession, empty).count() == 0


# --- quality

def test_quality_counts(docs, odd):
    for df in (docs, odd):
        rows = collections.Counter()
        for r in df.collect():
            text = r["text"] or ""
            w = WORD.findall(text)
            tri = collections.Counter(zip(w, w[1:], w[2:]))
            marked = {j for i in range(len(w) - 2) if tri[tuple(w[i:i + 3])] > 1 for j in (i, i + 1, i + 2)}
            lines = [x for x in text.split("\n") if WORD.search(x)]
            rows[r["doc_id"], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
                 len(marked), len(w) < 50 or 100 * len(marked) > 50 * len(w)] += 1
        got = quality.op5_query(df.sparkSession, df).collect()
        assert collections.Counter(tuple(r)[:7] for r in got) == rows
        assert not any(r["kept"] and r["base_failed"] for r in got)


def test_quality_bands_are_exact_quartiles(docs):
    vocabulary = Vocabulary.load()
    measured = quality.measures(docs, "doc_id", "text", "lang", vocabulary)
    rows = [r.asDict() for r in measured.collect()]
    for r in quality.bands(measured, min_group=10).where("length_class = -1 and figure = 'chars_per_token'").collect():
        xs = sorted(math.floor(x["chars_per_token"] * 1000 + 0.5) for x in rows if x["lang"] == r["lang"] and x["n_tokens"])
        q1, q2, q3 = (xs[math.ceil(len(xs) * q) - 1] / 1000 for q in (0.25, 0.5, 0.75))
        width = 2.5 * max(q3 - q1, q2 * quality.MIN_IQR)
        assert r["low"] == pytest.approx(q1 - width) and r["high"] == pytest.approx(q3 + width)


def measured_rows(spark, groups):
    """Measured rows from (lang, rows, same text, characters per token, its spread), 200 words each, entropy alike."""
    rng, rows = random.Random(3), []
    for lang, n, same, centre, spread in groups:
        for _ in range(n):
            x = centre if same else centre * (1 + rng.uniform(-spread, spread))
            rows.append((len(rows), lang, -1 if same else len(rows), 200, 800, 0, 0, 0, 300, x, 0.0, 3 * x))
    return spark.createDataFrame(rows, "id long, lang string, text_key long, " + quality.SCHEMA)


@pytest.mark.parametrize("same", [True, False])
def test_quality_bands_with_a_third_of_copies(spark, same):
    rows = measured_rows(spark, [("en", 400, False, 2.2, 0.04), ("en", 500, same, 2.2, 0.001), ("de", 600, False, 2.2, 0.04),
                                 ("en", 10, False, 1.7, 0.01)])
    out = quality.judge(rows).collect()
    kept = [r["id"] for r in out if r["kept"]]
    assert len(out) == 1510 and sorted(kept) == list(range(1500))


def test_quality_bands_of_a_rare_language(spark):
    rows = measured_rows(spark, [("en", 300, False, 2.2, 0.04), ("fr", 300, False, 1.9, 0.04), ("es", 5, False, 1.95, 0.02),
                                 ("xx", 3, False, 0.9, 0.02), ("ja", 20, False, 1.0, 0.04)])
    kept = collections.Counter(r["lang"] for r in quality.judge(rows).collect() if r["kept"])
    assert kept == {"en": 300, "fr": 300, "es": 5, "ja": 20}


def test_quality_keeps_prose_and_drops_rows_once(odd, empty):
    kept = quality.drop_rejected(odd)
    verdict = {(r["doc_id"]): r["kept"] for r in quality.op5_query(odd.sparkSession, odd).collect() if r["doc_id"] is not None}
    got = collections.Counter(r["doc_id"] for r in kept.collect())
    assert kept.columns == odd.columns
    assert got[3] == 3 * verdict[3] and all((got[i] > 0) == v for i, v in verdict.items())
    assert quality.op5_query(empty.sparkSession, empty).count() == 0 and quality.drop_rejected(empty).count() == 0


# --- html

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a = "</p><article>";</script></head><body>
<nav><ul><li><a href="/a">Home</a></li></ul></nav><div class="ad">Buy many nice things here today please</div>
<article><h1>A  title &amp; more</h1><p>First <i>para</i>graph of text.<p>Second&nbsp;one<br>line two</p>
<aside>see also</aside><form>name</form><div class="comments"><p>a reader writes</p></div></article>
<footer>&copy; someone</footer>"""


def test_html_extraction():
    weights = html.weights_of(html.count_tokens(PAGE * 3))
    want = "A title & more\nFirst paragraph of text.\nSecond one\nline two"
    assert html.extract(PAGE, weights) == want
    assert html.extract(PAGE.replace("</footer>", "</footer></body></html>").upper().replace("&AMP;", "&amp;"), weights).startswith("A TITLE & MORE\nFIRST PARA")
    for page in (None, "", "   ", "<", "<p", "<!--", "<script>x", "&&&", "<a href='x"):
        assert isinstance(html.extract(page, weights), str)
    assert html.extract("plain words only", weights) == "plain words only"


def test_html_long_page_is_whole():
    weights = html.weights_of(html.count_tokens(PAGE))
    page = "<article>" + "".join(f"<p>paragraph number {i}</p>" for i in range(20_000)) + "</article>"
    assert html.extract(page, weights).count("\n") == 19_999


WORDS = "An ordinary text of some length, with a few words in every sentence."
TAIL = '<div class="comments"><p>a reader writes</p></div><aside>see also</aside>'
REST = '<nav><a href="/a">Home</a></nav>{}<div class="ad">Buy many nice things here today please</div><footer>&copy; someone</footer>'


@pytest.mark.parametrize("page", [
    '<body class="no-sidebar">' + REST.format(f"<article><p>{WORDS}</p>{TAIL}</article>"),
    "<body>" + REST.format(f'<div class="layout with-sidebar"><article><p>{WORDS}</p>{TAIL}</article></div>'),
    "<body>" + REST.format(f'<article class="post notice"><p>{WORDS}</p>{TAIL}</article>'),
    "<body>" + REST.format(f'<main id="main-search"><article><p>{WORDS}</p>{TAIL}</article></main>'),
    "<body>" + REST.format(f'<form id="page"><article><p>{WORDS}</p>{TAIL}</article></form>'),
    "<body>" + REST.format(f'<div class="widget"><article><p>{WORDS}</p></article><div class="related"><article>card</article></div></div>'),
    "<body>" + REST.format(f'<div class="with-sidebar"><div class="has-banner"><p>{WORDS * 5}</p>{TAIL}</div></div>'),
    "<body>" + REST.format(f'<p>{WORDS}</p><div class="post notice"><p>{WORDS}</p></div>{TAIL}'),
])
def test_html_wrappers_with_names_of_boilerplate(page):
    weights = html.weights_of(html.count_tokens(PAGE * 3))
    got = html.extract(page, weights)
    assert got.replace("\n", "").replace(" ", "") == (WORDS * page.count(WORDS)).replace(" ", "")
    assert ("<article" not in page) == (not html.count_tokens(page))  # a labelled page stays one


def test_html_names_still_leave_regions_out():
    weights = html.weights_of(html.count_tokens(PAGE * 3))
    page = f'<body><div id="c"><p>{WORDS}</p></div><div class="comments"><p>{WORDS.upper() * 5}</p></div></body>'
    assert html.extract(page, weights) == WORDS


def test_html_long_run_counts_whole():
    weights = html.Weights()
    page = "<body><p>" + "long " * 900 + "</p>" + "<hr>" * 3000 + ("<p>" + "short " * 300 + "</p>") * 2 + "</body>"
    assert html.extract(page, weights).split() == ["long"] * 900


def test_html_query(spark):
    pages = read_table(spark, SF_SMALL, "pages")
    out = {r["page_id"]: r for r in queries.op2_html_extraction(spark, SF_SMALL).collect()}
    for r in pages.collect():
        body = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        parts = re.split(r"</?(?:p|h1|br)[^>]*>", body)
        want = "\n".join(x for x in (" ".join(html.htmllib.unescape(re.sub("<[^>]+>", "", p)).split()) for p in parts) if x)
        assert out[r["page_id"]]["text"] == want and out[r["page_id"]]["n_chars"] == len(want)
    odd = spark.createDataFrame([(1, None, None, "x"), (None, "u", "", "y"), (1, None, None, "x")], "page_id long, url string, html string, text string")
    assert [r["text"] for r in html.op2_query(spark, odd).collect()] == ["", "", ""]
    assert html.op2_query(spark, odd.limit(0)).count() == 0


# --- licences and search against SQL

@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    con.execute(f"CREATE VIEW twin AS {queries.oracle_sql()[name]}")
    got = queries.queries()[name](spark, SF_SMALL)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM twin").fetchall()
    assert sorted(map(str, want)) == sorted(map(str, map(tuple, got.collect())))


def test_license_forms(spark):
    mit = "Copyright (c) 2020 Jane Doe\n\n" + licenses.MIT.upper().replace(",", " ;") + "\n"
    british = licenses.APACHE_HEADER.replace("License", "Licence")
    rows = [(1, mit), (2, british), (3, licenses.MIT + " extra"), (4, None), (5, ""), (6, "x\n  released under the MIT licence!\ny"), (1, mit)]
    out = [tuple(r) for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).select("id", "license", "notices").collect()]
    assert sorted(out, key=str) == sorted([(1, "MIT", ""), (2, "Apache-2.0", ""), (3, None, ""), (4, None, ""), (5, None, ""),
                                           (6, None, "MIT"), (1, "MIT", "")], key=str)


@pytest.mark.parametrize("per_part", [5, 250_000])
def test_search_equals_all_pairs(spark, per_part):
    rng = random.Random(1)
    rows = [(i, rng.getrandbits(12) << 40 | rng.getrandbits(6)) for i in range(300)]
    rows += [(1000 + i, 77) for i in range(60)] + [(20, None), (None, 77), (20, 77)]
    df = spark.createDataFrame(rows, "id long, code long")
    got = collections.defaultdict(list)
    for r in hamming_search.top_k(df, df["id"] % 20 == 0, k=5, codes_per_part=per_part).collect():
        got[r["query_id"]].append((r["rank"], r["distance"], r["neighbour_id"]))
    plain = {(i, c) for i, c in rows if i is not None and c is not None}
    for q, code in plain:
        if q % 20 == 0 and q != 20:
            want = heapq.nsmallest(5, (((code ^ c).bit_count(), i) for i, c in plain if i != q))
            assert [(d, i) for _, d, i in sorted(got[q])] == want
    few = df.where("id < 3")
    assert hamming_search.top_k(few, few["id"] % 20 == 0, k=5).count() == 2
    assert hamming_search.top_k(df.limit(0), df["id"] % 20 == 0).count() == 0


def test_search_bounds_the_probes_of_a_part(spark, monkeypatch):
    """Rounds of many probes send a query to a part once; results leave in batches; the neighbours stay the same."""
    rng = random.Random(2)
    df = spark.createDataFrame([(i, rng.getrandbits(64) - 2**63) for i in range(400)], "id long, code long")
    found = lambda: sorted(map(tuple, hamming_search.top_k(df, df["id"] % 20 == 0, k=4, codes_per_part=40).collect()))
    want, rounds = found(), []
    plain = hamming_search._pack_probes
    monkeypatch.setattr(hamming_search, "_pack_probes", lambda *a: rounds.append((a[4], a[5])) or plain(*a))
    monkeypatch.setattr(hamming_search, "PROBES_PER_PART", 10)
    monkeypatch.setattr(hamming_search, "FLUSH", 1)
    assert found() == want
    assert any(radius for radius, _ in rounds) and all(everywhere for radius, everywhere in rounds if radius)


# --- pieces

def plain_paths(lattice, text):
    s, out = (" " + text).replace(pieces.MARK, "\0").replace(" ", pieces.MARK) if text else "", []

    def go(i, score, ids):
        if i == len(s):
            out.append((score, ids))
        for j in range(i + 1, len(s) + 1):
            if s[i:j] in lattice.score:
                go(j, score + lattice.score[s[i:j]], ids + [lattice.id[s[i:j]]])
        if i < len(s) and s[i] not in lattice.score:
            go(i + 1, score + lattice.unknown_score, ids + (lattice.edge_ids(s[i]) if s[i] != "\0" else [lattice.byte_ids[b] for b in pieces.MARK.encode()]))

    go(0, 0.0, [])
    return sorted(out, key=lambda x: -x[0])


def test_n_best_equals_all_paths():
    table = pieces.UnitTable(pieces.Lattice(Vocabulary.load()))
    rng = random.Random(3)
    for _ in range(150):
        text = "".join(rng.choice("the anson \n☃▁1 é") for _ in range(rng.randint(0, 8)))
        ids, paths = pieces.encode_text(text, table, 5)
        want = plain_paths(table.lattice, text)
        assert [round(p[0], 3) for p in paths] == [round(w[0], 3) for w in want[:5]]
        found = [pieces.path_ids(ids.tolist(), [dict(at=a, length=n, ids=x) for a, n, x in p[1]]) for p in paths]
        assert len(set(map(tuple, found))) == len(paths)
        assert all(any(f == w[1] and abs(p[0] - w[0]) < 1e-3 for w in want) for f, p in zip(found, paths))
        assert table.lattice.decode(ids.tolist()) == text


def test_pieces_round_trip(odd, empty):
    out = pieces.encode(odd)
    assert all(r["decoded_equal"] for r in out.collect()) and out.count() == len(odd_rows())
    back = collections.Counter((r["id"], r["text"]) for r in pieces.decode(out.select("id", "ids")).collect())
    assert back == collections.Counter((r[0], r[1] or "") for r in odd_rows())
    assert pieces.op8_query(empty.sparkSession, empty).count() == 0


# --- toxicity

def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    usual = ["river", "stone", "window", "garden", "letter", "market", "summer", "winter", "paper", "house", "forest"]
    rude = ["zorkfaced", "blithgut", "mugwumped", "snarlwit", "grobnard"]
    rows, marks = [], []
    for i in range(600):
        toxic = i % 4 == 0
        words = [rng.choice(usual) + rng.choice(["", "s", "ly"]) for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(rude))
        rows.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    docs = spark.createDataFrame(rows + [(9000, None), (9001, ""), (None, "river"), (3, rows[3][1])], "doc_id long, text string")
    out = toxicity.op7_query(spark, docs, spark.createDataFrame(marks + [(9000, None), (None, 1)], "doc_id long, toxic int")).collect()
    assert len(out) == 604 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in out)
    held = [(r["predicted"], marks[r["doc_id"]][1]) for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 600]
    assert sum(p == y for p, y in held) / len(held) > 0.95
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out if r["doc_id"] is not None)


def test_toxicity_without_labels(odd, empty, labels):
    none = toxicity.fit(odd, labels.limit(0))
    assert {r["score"] for r in toxicity.score_documents(none, odd).collect()} == {0.0}
    assert toxicity.drop_toxic(none, odd).count() == odd.count()
    assert toxicity.op7_query(empty.sparkSession, empty, labels).count() == 0


# --- language model

def test_lm_base_counts(docs, odd):
    for df in (docs, odd):
        rows = [(r["doc_id"], lower(r["text"])) for r in df.collect()]
        tokens = [WORD.findall(t) + [None] for _, t in rows]
        held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
        count = collections.Counter(w for t, h in zip(tokens, held) if not h for w in t)
        n, v = sum(count.values()), len(count)
        want = collections.Counter(
            (i, h, len(t), sum(count[w] > 0 for w in t), n, round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in t), 4))
            for (i, _), t, h in zip(rows, tokens, held))
        out = maxent_lm.op6_query(df.sparkSession, df).collect()
        assert collections.Counter((*tuple(r)[:5], round(r["base_score"], 4)) for r in out) == want
        assert all(r["score"] < 0 for r in out)


def test_lm_beats_the_base_on_held_out_rows(docs):
    out = [r for r in maxent_lm.op6_query(docs.sparkSession, docs).collect() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_lm_does_not_depend_on_the_layout(docs):
    one, many = ({r["doc_id"]: r["score"] for r in maxent_lm.op6_query(df.sparkSession, df).collect()}
                 for df in (docs.coalesce(1), docs.repartition(40, "doc_id")))
    assert one.keys() == many.keys() and all(many[i] == pytest.approx(x, rel=1e-4) for i, x in one.items())


def plain_row(template, feature, node, rows):
    """The weight row of one feature and choice, in Python integers."""
    m = 2**64 - 1
    x = ((feature + template * 0xD6E8FEB86659FD93) * 0x9E3779B97F4A7C15 + node * 0xBF58476D1CE4E5B9) & m
    x = ((x ^ (x >> 32)) * 0x94D049BB133111EB) & m
    return x >> (65 - rows.bit_length())


def plain_log10(model, history, path):
    """log10 of a path's choices after a history (latest first), one choice and output at a time."""
    one, two, three = history
    features, total = (one, one * maxent_lm.HISTORY + two, two, three), 0.0
    for node, child in path:
        z = [float(model.bias[node][k]) + sum(
            float(model.weights[plain_row(t, f, node, len(model.weights))][k]) for t, f in enumerate(features)) for k in range(maxent_lm.WIDTH)]
        total += (z[child] - max(z) - math.log(sum(math.exp(x - max(z)) for x in z))) / math.log(10)
    return total


def test_lm_score_equals_a_plain_model(docs, monkeypatch):
    """Every factor of the score from a dictionary of the training words and the weights; all words' probabilities add up to 1."""
    caught = {}
    monkeypatch.setattr(maxent_lm, "train", lambda e, s, f=maxent_lm.train: caught.setdefault("model", f(e, s)))
    monkeypatch.setattr(maxent_lm, "statistics", lambda c, n, f=maxent_lm.statistics: caught.setdefault("stats", f(c, n)))
    few = docs.where("doc_id < 120")
    got = {r["doc_id"]: r["score"] for r in maxent_lm.op6_query(docs.sparkSession, few).collect()}
    model, stats = caught["model"], caught["stats"]
    texts = {r["doc_id"]: WORD.findall(lower(r["text"])) for r in few.collect()}
    count = collections.Counter(w.encode() for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2 for w in t)
    usual = sorted(((-c, w) for w, c in count.items() if c > 2))[:maxent_lm.SINGLES]
    single = {w: k for k, (_, w) in enumerate(usual)}
    of_count = [sum(c == k for c in count.values()) for k in (1, 2, 3)]
    assert [w for w, _ in stats.top] == [w for _, w in usual] and list(stats.of_count) == of_count
    mass = collections.Counter()
    for w, c in count.items():
        if c > 2 and w not in single:
            mass[int(model.cluster[maxent_lm.SINGLES + 2 + maxent_lm.ending_of(w)]), maxent_lm.part_of(w)] += c - maxent_lm.DISCOUNT

    def path_of(word):
        """(choices, log10 of the share inside)."""
        c = count.get(word, 0)
        if word is None or word in single or c <= 2:
            k = maxent_lm.END if word is None else single.get(word, maxent_lm.RARE)
            shares = [of_count[0], 2 * of_count[1], 3 * of_count[2]]
            inside = 0.0 if word is None or word in single else math.log10(shares[c] / sum(shares) / max([1, of_count[0], of_count[1]][c], 1))
            return [(0, k // 8), (1 + k // 8, k % 8)], inside
        k, part = int(model.cluster[maxent_lm.SINGLES + 2 + maxent_lm.ending_of(word)]), maxent_lm.part_of(word)
        return ([(0, k // 8), (1 + k // 8, k % 8), (1 + maxent_lm.SUPERS + k, part)],
                math.log10(c - maxent_lm.DISCOUNT) - math.log10(mass[k, part]))

    number = lambda w: zlib.crc32(b"h" + w) % (maxent_lm.HISTORY - 1)
    start = maxent_lm.HISTORY - 1
    for i in sorted(texts, key=lambda i: len(texts[i]))[:25]:
        words = [w.encode() for w in texts[i]] + [None]
        want = 0.0
        for at, w in enumerate(words):
            history = [number(words[at - k]) if at >= k else start for k in (1, 2, 3)]
            path, inside = path_of(w)
            want += plain_log10(model, history, path) + inside
        assert got[i] == pytest.approx(want, rel=1e-4, abs=1e-3)
    history = (number(usual[0][1]), number(usual[1][1]), start)
    whole = sum(10 ** (plain_log10(model, history, p) + x) for p, x in map(path_of, [None, b"\x00unseen", *count]))
    assert 0.97 < whole < 1.0001  # parts without words hold the rest


def test_lm_rounds_add_up_plain_counts(monkeypatch):
    """Counts and gradients against sums token by token; the first round computes no probabilities per token."""
    rng = np.random.default_rng(6)
    rows, w = 256, maxent_lm.WIDTH
    cluster = np.concatenate([np.arange(maxent_lm.RARE + 1), rng.integers(maxent_lm.RARE + 1, maxent_lm.CLASSES, maxent_lm.ENDINGS)])
    group = rng.integers(0, maxent_lm.GROUPS, 500)
    group[::3] = rng.integers(0, maxent_lm.RARE + 1, len(group[::3]))
    codes = (group * w + np.where(group > maxent_lm.RARE, rng.integers(0, w, 500), 0)).astype(np.uint16)
    history, lengths, held = rng.integers(0, 50, 500).astype(np.uint16), [200, 1, 299], [False, True, False]
    bias = maxent_lm._shares(cluster, np.bincount(codes, minlength=maxent_lm.GROUPS * w).reshape(-1, w).astype(float))
    model = maxent_lm.Model(cluster, np.zeros((maxent_lm.CLASSES, w)), bias, np.zeros((rows, w), dtype=np.float32))
    features = maxent_lm.features_of(history, np.array(lengths))

    def plain():
        seen, expected = np.zeros((rows, w)), np.zeros((rows, w))
        on_bias = np.zeros((maxent_lm.NODES, w))
        for i in set(range(500)) - {200}:
            c = int(cluster[codes[i] // w])
            path = [(0, c // w), (1 + c // w, c % w), (1 + maxent_lm.SUPERS + c, int(codes[i]) % w)]
            for node, child in path[:3 if c > maxent_lm.RARE else 2]:
                at = [plain_row(t, int(f), node, rows) for t, f in enumerate(features[:, i])]
                z = np.exp(model.bias[node].astype(float) + sum(model.weights[r].astype(float) for r in at))
                on_bias[node] -= z / z.sum()
                on_bias[node, child] += 1
                for r in at:
                    seen[r, child] += 1
                    expected[r] += z / z.sum()
        return seen, expected, on_bias

    with monkeypatch.context() as m:
        m.setattr(maxent_lm, "choice_probabilities", None)
        got = np.zeros(2 * rows * w, dtype=np.float32)
        maxent_lm._first_counts(model)(got, codes, history, lengths, held)
    seen, expected, _ = plain()
    assert np.allclose(got.reshape(2, w, rows), [seen.T, expected.T], atol=1e-3)
    model.weights[:] = rng.normal(size=(rows, w)) * 0.2
    got = np.zeros((rows + maxent_lm.NODES) * (w - 1), dtype=np.float32)
    maxent_lm._gradient(model)(got, codes, history, lengths, held)
    seen, expected, on_bias = plain()
    assert np.allclose(got.reshape(w - 1, -1), np.concatenate([seen - expected, on_bias])[:, :w - 1].T, atol=1e-3)


def test_lm_rounds_work_on_whole_tables_once_per_group_of_chunks(spark):
    """Chunks are added up together until they hold a quarter of the vector's length in tokens, not one by one."""
    rows = [(bytes(2 * n), bytes(2 * n), [n], [i % 3 == 0]) for i, n in enumerate([5, 1, 7, 2, 9, 4, 3, 8, 6, 10])]
    encoded = spark.createDataFrame(rows, "codes binary, history binary, lengths array<int>, held array<boolean>").coalesce(1)

    def add(total, codes, history, lengths, held):
        total[0] += 1
        total[1] += len(codes)
        total[2] += (np.array(lengths) * ~np.array(held)).sum()
        total[3] += len(history)

    for size, calls in ((4_000, 1), (80, 3), (4, 10)):
        got = maxent_lm._reduce(encoded, size, 1, add)
        assert got[:4].tolist() == [calls, 55, 55 - 5 - 2 - 3 - 10, 55] and not got[4:].any()


def test_lm_chunks_hold_the_words_of_the_plain_rule(spark):
    odd = [" a  B\x0bc\td\r\ne\x0c ", "", None, " \n\t", "x\x1cy\x85z\x1f \u00a0Q\u2003R ÄÖ É", "A a A\x00 a", "\U0001f600 İI", "one"]
    texts = [*odd, "Word wörd " * 400_000, *odd, "end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    chunks, got = maxent_lm.tokenise(docs, "doc_id", "text").collect(), {}
    assert len(chunks) > 1
    for r in chunks:
        words, flat = [None, *bytes(r["words"]).split()], np.frombuffer(r["tokens"], dtype=np.int32)
        assert r["n_words"] == len(words) - 1 == len(set(words[1:])) and len(flat) == sum(r["lengths"])
        of_doc = np.split(flat, np.cumsum(r["lengths"])[:-1])
        got |= {i: [words[k] for k in line] for i, line in zip(r["ids"], of_doc)}
        kept = np.concatenate([line[:0] if h else line for line, h in zip(of_doc, r["held"])])
        assert np.frombuffer(r["counts"], dtype=np.int32).tolist() == np.bincount(kept, minlength=len(words)).tolist()
        assert r["held"] == [zlib.crc32(str(i).encode()) % 7 == 2 for i in r["ids"]]
    assert got == {i: [*(w.encode() for w in WORD.findall(lower(t))), None] for i, t in enumerate(texts)}


def test_lm_of_nothing(empty):
    assert maxent_lm.op6_query(empty.sparkSession, empty).count() == 0


# --- mixing

def test_rates_meet_the_targets(docs, labels):
    out = mixing.op1_query(docs.sparkSession, docs, labels).collect()
    p = np.array([[r["p_good"], r["p_poor"], r["p_toxic"]] for r in out])
    n = np.array([r["n_tokens"] for r in out], dtype=float)
    rate = np.array([r["rate"] for r in out])
    assert len(out) == docs.count() and (rate >= 0).all() and np.allclose(p.sum(axis=1), 1)
    assert n.tolist() == [len(WORD.findall(t)) for t in (dict((r["doc_id"], r["text"]) for r in docs.collect())[x["doc_id"]] for x in out)]
    got = (n * rate) @ p / n.sum()
    assert np.abs(got - [0.90, 0.08, 0.02]).sum() < 0.02


def test_projected_gradient_equals_a_long_plain_run(spark):
    rng = np.random.default_rng(1)
    p = rng.dirichlet([0.4, 0.4, 0.4], size=200)
    n = rng.integers(0, 50, 200)
    table = spark.createDataFrame([(i, int(a), b.tolist()) for i, (a, b) in enumerate(zip(n, p))], "id long, n_tokens long, p array<double>")
    passes, totals, target = mixing.fit_rates(table, {"a": 0.1, "b": 0.6, "c": 0.3}, ("a", "b", "c"))
    w = n / n.sum()
    r, inverse = np.ones(200), np.linalg.pinv((p * w[:, None]).T @ p)
    for _ in range(3000):
        r = np.maximum(0, r - p @ (inverse @ ((w * r) @ p - target)))
    rates = mixing.rates_of(p, passes)
    assert (rates >= 0).all() and np.allclose(totals, (w * rates) @ p)
    assert np.abs((w * rates) @ p - (w * r) @ p).sum() < 1e-3


def posterior_rows(spark, shares, n, sharp=4.0):
    rng = np.random.default_rng(4)
    z = rng.normal(size=(n, 3))
    z[np.arange(n), rng.choice(3, n, p=shares)] += sharp
    p, n = mixing.softmax(z), rng.integers(1, 500, n)
    return p, n, spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p)], "n_tokens long, p array<double>")


@pytest.mark.parametrize("shares", [(0.5, 0.2, 0.3), (0.05, 0.6, 0.35)])
def test_rates_reach_the_targets_of_a_small_domain(spark, shares):
    p, n, table = posterior_rows(spark, shares, 3000)
    prices, totals, target = mixing.fit_rates(table, mixing.TARGETS)
    rates = mixing.rates_of(p, prices)
    assert (rates >= 0).all() and target.tolist() == pytest.approx([0.90, 0.08, 0.02])
    assert np.abs((n * rates) @ p / n.sum() - target).sum() <= 1.01 * mixing.TOLERANCE
    assert np.allclose(totals, (n * rates) @ p / n.sum(), atol=1e-9)


def test_rates_for_targets_out_of_reach_are_optimal(spark):
    p, n, table = posterior_rows(spark, (0.2, 0.5, 0.3), 300, sharp=0.5)
    prices, totals, target = mixing.fit_rates(table, {"good": 1.0})
    w, rates = n / n.sum(), mixing.rates_of(p, prices)
    pull = p @ np.linalg.inv((p * w[:, None]).T @ p) @ (totals - target)
    assert np.abs(totals - target).sum() > 0.1 and np.allclose(totals, (w * rates) @ p)
    assert pull.min() > -1e-5 and np.abs(pull[rates > 0]).max() < 1e-5


def test_missed_targets_are_told(odd, labels):
    with pytest.warns(UserWarning, match="no nonnegative rates reach the targets"):
        mixing.op1_query(odd.sparkSession, odd, labels.limit(0))


def test_mixing_odd_rows(odd, empty, labels):
    out = mixing.mix_documents(odd, labels, {"good": 1.0, "poor": 0.5, "toxic": 0.5}, factors=True)
    assert out.columns == odd.columns and set(r["doc_id"] for r in out.collect()) <= set(r[0] for r in odd_rows())
    assert mixing.op1_query(empty.sparkSession, empty, labels).count() == 0
    assert mixing.op1_query(odd.sparkSession, odd, labels.limit(0)).count() == len(odd_rows())
    assert mixing.copies_of(np.array([0.0, 1.0, 2.5]), [1, None, 3])[:2].tolist() == [0, 1]

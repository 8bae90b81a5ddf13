"""The pipeline's stages against plain versions of their decisions."""

import collections

import corpus_pipeline
import pytest
from conftest import SF_SMALL
from panelcast.llm import mixing, quality, simhash, toxicity
from panelcast.llm.common import read_table


def test_stages(spark, tmp_path):
    docs = read_table(spark, SF_SMALL, "documents")
    labels = read_table(spark, SF_SMALL, "labels")
    columns = docs.columns
    seen = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_SMALL)
        out.write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        ids = collections.Counter(r["doc_id"] for r in out.select("doc_id").collect())
        rows = docs.collect()
        if k == 0:
            keep = {r["doc_id"] for r in quality.op5_query(spark, docs).where("kept").collect()}
        elif k == 1:
            model = toxicity.fit(docs, labels)
            keep = {r["doc_id"] for r in rows if toxicity.scores(model, [r["text"]])[0] < 0.5}
        elif k == 2:
            keep = {r["component_id"] for r in simhash.op9_query(spark, docs).collect()}
        elif k == 3:
            domains = tuple(corpus_pipeline.MIX)
            classifier = mixing.fit_classifier(docs, labels, domains)
            passes, totals, _ = mixing.fit_rates(mixing.posterior_table(docs, classifier), corpus_pipeline.MIX, domains, budget=True)
            p, n = classifier.posteriors([r["text"] for r in rows])
            has = n @ p / n.sum()
            good, poor = corpus_pipeline.MIX.values()
            assert totals.tolist() == pytest.approx([has[0], min(has[1], has[0] * poor / good)], abs=1e-4)
            rates = mixing.rates_of(classifier.posteriors([r["text"] for r in rows])[0], passes)
            copies = mixing.copies_of(rates, [r["doc_id"] for r in rows])
            assert ids == collections.Counter({r["doc_id"]: int(c) for r, c in zip(rows, copies) if c})
            keep = set(ids)
        else:
            keep = {r["doc_id"] for r in rows}
            assert all(r["decoded_equal"] and r["n_tokens"] == len(r["ids"]) for r in out.collect())
        assert set(ids) == keep
        if k < 4:
            assert out.columns == columns
        seen.append(out.count())
        docs = out
    assert seen[-1] > 0 and seen[0] < read_table(spark, SF_SMALL, "documents").count()


def test_run_equals_the_stages(spark):
    toxicity.scores(toxicity.fit(read_table(spark, SF_SMALL, "documents"), read_table(spark, SF_SMALL, "labels")), ["a text"])
    out = corpus_pipeline.run(spark, SF_SMALL)  # after driver-side calls have filled the driver's own tables
    assert out.count() > 0 and out.where("not decoded_equal").count() == 0


def test_odd_and_empty_tables(spark, tmp_path):
    """Nulls in any column, repeated rows, no rows and no labels go through every stage."""
    base = read_table(spark, SF_SMALL, "documents")
    rows = base.limit(40).collect()
    odd = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in rows] * 2 + [
        (None, rows[0]["text"], None, None, None), (900_001, None, "en", None, None), (900_002, "", None, "s", 0), (None, None, None, None, None)]
    labels = read_table(spark, SF_SMALL, "labels")
    for k, (data, marks) in enumerate(((odd, labels), ([], labels), (odd, labels.limit(0)))):
        spark.createDataFrame(data, base.schema).write.parquet(f"{tmp_path}/{k}/documents.parquet")
        marks.write.parquet(f"{tmp_path}/{k}/labels.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{k}").collect()
        assert {r["doc_id"] for r in out} <= {d[0] for d in data} and all(r["decoded_equal"] for r in out)


def test_caches_stay_where_they_are(spark):
    """What a function ships does not grow with the tables that its worker holds."""
    from pyspark import cloudpickle

    from panelcast.llm import pieces
    from panelcast.llm.vocabulary import Vocabulary

    vocabulary = Vocabulary.load()
    before = len(cloudpickle.dumps(pieces.unit_table))
    table = pieces.unit_table(vocabulary)
    pieces.encode_text("some words that are kept", table, 3)
    assert len(cloudpickle.dumps(pieces.unit_table)) == before < 100_000 and pieces.unit_table(vocabulary) is table

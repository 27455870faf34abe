from __future__ import annotations

import re

import corpus_pipeline
from burstline.llm import pii, quality
from tests.llm import test_lines, test_minhash, test_packing, test_pii


def test_every_stage_against_a_plain_version(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        if name != "packing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
            out = out.cache()
        rows[name] = (docs.collect(), out.collect())
        docs = out

    before, after = rows["quality classifier"]
    labels = spark.read.parquet(f"{tables}/labels.parquet").filter(~quality.held_out())
    model = quality.fit(spark.createDataFrame(before), labels)
    indicators = quality.Indicators()
    good = [r for r in before if model.score(indicators.of((r.text or "").encode())) >= 0.3]
    assert sorted(after) == sorted(good) and len(after) < len(before)

    before, after = rows["line dedup"]
    truth = {i: t for i, t, _, _ in test_lines.brute([(r.doc_id, r.text) for r in before], 5, 40)}
    assert {r.doc_id: r.text for r in after} == truth
    assert all(r.n_chars == len(r.text) for r in after)

    before, after = rows["near-copy dedup"]
    truth = test_minhash.brute([(r.doc_id, r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(r[0] for r in truth if r[3])

    before, after = rows["personal data"]
    given = {r.doc_id: r.text for r in before}
    for r in after:
        assert r.text == pii.masked(given[r.doc_id], pii.find_spans(given[r.doc_id]))
        assert r.n_chars == len(r.text) and not re.search(test_pii.EMAIL, r.text)

    before, after = rows["packing"]
    test_packing.check(after, {r.doc_id: r.text for r in before})


def test_run_equals_the_stages(spark, tables):
    out = corpus_pipeline.run(spark, tables)
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, tables)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    key = lambda frame: sorted({(r.doc_id, r.doc_tokens) for r in frame.select(columns).collect()})
    assert key(out) == key(docs)


def test_stages_on_odd_rows(spark, tables):
    schema = "doc_id long, text string, lang string, source string, n_chars long, kept string"
    rows = [(1, None, "en", None, 5, "x"), (2, "", None, "s", 0, None), (None, "words", "en", "s", 5, "y")]
    clashing = ["_score", "_null", "_kept", "_lost", "_id", "n_lines", "n_dropped", "component"]
    odd = spark.createDataFrame(rows, schema).selectExpr(
        "*", *(f"coalesce(doc_id, 0) + {k} AS {name}" for k, name in enumerate(clashing))
    )
    for frame in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, tables)
            found = out.collect()
            if name != "packing":
                assert out.columns == frame.columns
                for row in found:
                    values = [row[c] for c in clashing]
                    assert values == [(row.doc_id or 0) + k for k in range(len(clashing))]
            if name in ("line dedup", "near-copy dedup", "personal data"):
                assert len(found) == frame.count()
                assert {r.doc_id: r.text for r in found} == {r.doc_id: r.text for r in frame.collect()}

"""The pipeline's stages: what goes, what stays, and what they return."""

import pyarrow as pa

import corpus_pipeline
from clearspark.session import landed
from tests.llm.cases import empty_table, odd_table, prose, shingles

FOLDER = "/root/testdata/sf0.01"


def test_stages_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = {r.text for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = landed(stage(spark, docs, FOLDER), "test-stage")
        assert found.columns == docs.columns
        docs, seen[name] = found, {r.doc_id: r for r in found.collect()}
    assert len(seen["language ID"]) > 0.99 * len(before)
    kept = seen["n-gram Jaccard join"]
    sets = {k: shingles(r.text, 5) for k, r in seen["language ID"].items()}
    gone = set(sets) - set(kept)
    by_gram: dict = {}
    for k in kept:
        for g in sets[k]:
            by_gram.setdefault(g, set()).add(k)
    for k in list(gone)[:100]:
        near = set().union(*(by_gram.get(g, set()) for g in sets[k]))
        assert any(5 * len(sets[k] & sets[x]) >= 4 * len(sets[k] | sets[x]) for x in near) or k > min(sets)
    clean = seen["benchmark decontamination"]
    for k, r in kept.items():
        holds = any(i in r.text for i in items)
        assert (k not in clean) or not holds
    masked = seen["PII"]
    assert set(masked) == set(clean)
    assert not any("@mail" in r.text for r in masked.values())
    assert all(r.n_chars == len(r.text) for r in masked.values())
    last = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert {r.doc_id for r in last} == set(masked)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.select("doc_id", "start", "length", "ids_crc32").collect())) == sorted(
        (r.doc_id, r.start, r.length, r.ids_crc32) for r in last
    )


def test_stages_take_odd_rows_and_empty_tables(spark):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd_table(spark), FOLDER).collect()
        assert stage(spark, empty_table(spark), FOLDER).count() == 0


def test_wide_rows_go_to_python_in_batches_of_bounded_bytes(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "bytes"])

    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    rows = spark.range(0, 6000, 1, 1).selectExpr("id", "repeat('x', 4000) AS text")
    found = landed(rows.mapInArrow(sizes, "n long, bytes long"), "test-batches").collect()
    assert sum(r.n for r in found) == 6000 and max(r.bytes for r in found) < 5_000_000
    assert spark.conf.get(name) == before


def test_stages_that_send_texts_to_python_return_landed_rows(spark):
    for stage in (corpus_pipeline.keep_languages, corpus_pipeline.drop_leaks):
        plan = stage(spark, odd_table(spark), FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "InArrow" not in plan


def test_one_of_each_group_stays(spark):
    base = prose(3, 90)
    rows = [(5, base), (2, base + " more"), (9, prose(4, 50)), (9, prose(4, 50)), (9, prose(5, 50)), (None, base), (1, None), (1, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, name string")
    found = corpus_pipeline.keep_one_of_each(spark, docs, FOLDER).collect()
    assert sorted((r.doc_id, r.text or "") for r in found) == sorted(
        [(1, ""), (1, ""), (2, base + " more"), (9, prose(4, 50)), (9, prose(5, 50))]
    )

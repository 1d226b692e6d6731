"""The stages, each against a plain version of what it decides, and the whole run."""

import re

import pytest

import corpus_pipeline as pipeline
from routeloom.llm.queries import QUERIES, SQL
from tests.llm.test_duplicates import expected_groups, expected_lines, shingle_sets
from tests.llm.test_filters import expected_hits
from tests.llm.test_placement import encoded


@pytest.fixture(scope="module")
def folder(spark, docs, rows, tmp_path_factory):
    path = f"file://{tmp_path_factory.mktemp('tables')}"
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs.select(*columns).write.parquet(f"{path}/documents.parquet")
    item = " ".join(rows[25][1].split()[:30])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    labels = [(r[0], int("%%" not in (r[1] or "")), 0) for r in rows if r[0] % 2]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    stages = dict(pipeline.STAGES)
    judged = stages["quality classifier"](spark, docs, folder)
    assert judged.columns == columns and judged.subtract(docs).count() == 0
    before = [tuple(r) for r in docs.collect()]
    after = {r["doc_id"]: r for r in stages["line dedup"](spark, docs, folder).collect()}
    want = expected_lines(before)
    for i, text, _, _, _ in before:
        assert after[i]["text"] == (None if text is None else "\n".join(want[i]))
    kept = {r["doc_id"] for r in stages["MinHash near-dedup"](spark, docs, folder).collect()}
    groups = expected_groups(shingle_sets(before, 5), 80)
    assert kept == {i for i, group in groups.items() if i == group}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    hits = expected_hits(before, items, 13)
    clean = {r["doc_id"] for r in stages["benchmark decontamination"](spark, docs, folder).collect()}
    assert clean == {i for i, (n, hit, _) in hits.items() if not (hit and 20 * hit >= n)}
    assert len(clean) < len(before)


def test_run(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), docs.schema)
    want = {r["doc_id"]: len(encoded(r["text"])) for r in docs.collect()}
    got = pipeline.run(spark, folder).groupBy("doc_id").sum("length").collect()
    assert {r[0]: r[1] for r in got} == want


def test_empty_tables(spark, folder, tmp_path):
    path = f"file://{tmp_path}"
    for table in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{folder}/{table}.parquet").limit(0).write.parquet(f"{path}/{table}.parquet")
    assert pipeline.run(spark, path).count() == 0


def test_all_operators_have_queries():
    numbers = {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES}
    assert numbers == set(range(1, 11)) and set(SQL) <= set(QUERIES)

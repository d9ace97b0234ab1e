"""The pipeline stage by stage, and the registered queries against SQL."""

import importlib
import re

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from caseflow.llm.common import BATCH_BYTES
from caseflow.llm.packing import pack
from caseflow.llm.quality import classify, keep_good
from caseflow.llm.queries import ORACLES, QUERIES
from checks.compare import _rows, connect

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.store(stage(spark, docs, SF))
        kept[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    before, after = kept["quality classifier"]
    rejected = {r.doc_id for r in classify(before, labels).filter("rejected").collect()}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in before.collect()} - rejected
    before, after = kept["exact dedup"]
    assert sorted(r.text for r in after.collect()) == sorted({r.text for r in before.collect()})
    before, after = kept["near dedup"]
    assert 0.9 * before.count() <= after.count() <= before.count()
    before, after = kept["mixing"]
    size = {r.doc_id: len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) for r in before.collect()}
    assert abs(sum(size[r.doc_id] for r in after.collect()) - 1.5 * sum(size.values())) < 0.01 * sum(size.values())
    before, after = kept["packing"]
    assert after.agg({"length": "sum"}).first()[0] >= before.count()


@pytest.mark.parametrize("module", ["quality", "packing"])
def test_text_goes_to_workers_in_small_batches(spark, module, monkeypatch):
    """Words, n-grams and ids take many times the bytes of a batch, and two workers share an executor's memory."""
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    module, limits = importlib.import_module(f"caseflow.llm.{module}"), []

    def stored(df, plain=module.store):
        if "MapInArrow" in df._jdf.queryExecution().executedPlan().toString():
            limits.append(int(spark.conf.get(BATCH_BYTES, str(64 << 20))))
        return plain(df)

    monkeypatch.setattr(module, "store", stored)
    (keep_good(docs, labels) if module.__name__.endswith("quality") else pack(docs)).count()
    assert limits and max(limits) <= 1 << 20
    assert spark.conf.get(BATCH_BYTES, None) is None


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.store(stage(spark, docs, SF))
    assert docs.count() == 0


def test_registered():
    names = set(contract.queries())
    assert set(QUERIES) < names and "pipeline" in names and set(ORACLES) < set(contract.oracle_sql())
    assert {int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    frame = QUERIES[name](spark, SF)
    cursor = connect(SF).execute(ORACLES[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert _rows(frame.columns, frame.collect()) == _rows(columns, cursor.fetchall())

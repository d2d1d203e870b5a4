"""The registered queries against their SQL, and the pipeline stage by stage against plain Python."""

import importlib.util

import corpus_pipeline
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from tallyroute.llm import decontaminate, packing
from tallyroute.llm.queries import ORACLES, QUERIES, table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_agrees_with_sql(spark, name):
    assert difference(spark, connect(SF), QUERIES[name], ORACLES[name], SF) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_returns_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near_duplicates", "decontamination", "mix", "packing"]


def test_entry_registers_them():
    import __spark_entry__ as contract

    assert set(QUERIES) | {"pipeline"} <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


def test_library_does_without(monkeypatch):
    """With the subpackage gone the entry still loads, and offers the other queries."""
    import sys

    for name in [n for n in sys.modules if n.startswith("tallyroute.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.setitem(sys.modules, "tallyroute.llm", None)
    found = importlib.util.spec_from_file_location("entry_without", contract_path())
    module = importlib.util.module_from_spec(found)
    found.loader.exec_module(module)
    assert "dataset_profile" in module.queries() and not any(n.startswith("op1_") for n in module.queries())


def contract_path():
    from pathlib import Path

    return Path(__file__).resolve().parents[2] / "__spark_entry__.py"


def test_pipeline_stages(spark, tmp_path):
    docs = table(spark, SF, "documents")
    odd = [(9_000, None, "en", "src1", 0), (9_001, "", "en", "src1", 0), (9_002, "12 34 !!", "en", None, 8), (9_003, docs.first().text, "en", None, 1)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).withColumn("row", F.lit("extra"))
    seen = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, SF)
        if name != "packing":
            assert made.columns == docs.columns
        made.write.parquet(str(tmp_path / name))
        docs = seen[name] = spark.read.parquet(str(tmp_path / name))
    ids = {name: [r.doc_id for r in df.select("doc_id").collect()] for name, df in seen.items() if name != "packing"}
    assert set(ids["documents"]) - set(ids["language"]) == {9_000, 9_001, 9_002}
    groups = QUERIES["op7_simhash_components"](spark, SF).collect()
    assert set(ids["near_duplicates"]) == {r.component_id for r in groups} and len(ids["near_duplicates"]) == len(set(ids["near_duplicates"]))
    leaks = {r.doc_id for r in decontaminate.leaks(seen["near_duplicates"], table(spark, SF, "benchmark")).collect()}
    assert leaks and set(ids["decontamination"]) == set(ids["near_duplicates"]) - leaks
    assert set(ids["mix"]) <= set(ids["decontamination"]) and max(map(ids["mix"].count, set(ids["mix"]))) <= 3
    packed = packing.pieces_of(seen["packing"]).where("doc_offset = 0")
    assert sorted(r.doc_id for r in packed.collect()) == sorted(ids["mix"])
    total = corpus_pipeline.run(spark, SF).agg(F.sum("n_tokens")).first()[0]
    assert total > 10_000

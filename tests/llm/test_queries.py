"""Every registered query of the package: against its SQL, or its rows against the table; and the pipeline."""

import importlib
from pathlib import Path

import duckdb
import pytest
from conftest import SF

import __spark_entry__ as entry
import corpus_pipeline
from stratalake.llm import linededup, oracles, pii, queries, simhash
from tools.check import TABLES, compare


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_registered():
    names = set(queries.registered())
    assert names <= set(entry.queries()) and len(names) == 14 and set(oracles.sql_by_query()) < names
    assert set(oracles.sql_by_query()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracles.sql_by_query()))
def test_matches_sql(spark, duck, name):
    verdict, _ = compare(spark, duck, SF, name, entry.queries()[name], oracles.sql_by_query()[name])
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize("number", [1, 4, 5, 6, 7, 8, 12])
def test_one_row_for_each_document(spark, number):
    name = next(n for n in queries.registered() if n.startswith(f"op{number}_"))
    found = entry.queries()[name](spark, SF)
    assert sorted(r.doc_id for r in found.select("doc_id").collect()) == list(range(200))


def test_pipeline_stage_by_stage(spark):
    docs = queries.table(spark, SF, "documents")
    (_, reject), (_, lines), (_, near), (_, personal), (_, pack) = corpus_pipeline.STAGES
    kept = reject(spark, docs, SF)
    labels = queries.table(spark, SF, "labels")
    assert kept.columns == docs.columns and kept.join(labels.where("toxic = 0"), "doc_id").count() >= 0.95 * labels.where("toxic = 0").count()
    shorter = lines(spark, kept, SF)
    digests = {r.doc_id: r.n_dropped for r in linededup.dropped_digests(kept).collect()}
    before = {r.doc_id: r.text for r in kept.collect()}
    assert {r.doc_id: len((before[r.doc_id] or "").split("\n")) - len(r.text.split("\n")) for r in shorter.collect() if r.text} == {
        d: n for d, n in digests.items() if n < len((before[d] or "").split("\n"))
    }
    single = near(spark, shorter, SF)
    groups = {r.component_id for r in simhash.near_duplicates(shorter).collect()}
    assert {r.doc_id for r in single.collect()} == groups and single.count() == len(groups)
    masked = personal(spark, single, SF)
    assert not any(found for r in masked.collect() for kind, found in pii.spans(r.text or "").items() if kind in ("email", "ip"))
    packed = pack(spark, masked, SF)
    assert {r.doc_id for r in packed.collect()} == groups
    whole = corpus_pipeline.run(spark, SF)
    places = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(whole.select(*places).collect()) == sorted(packed.select(*places).collect())


def test_nothing_else_imports_the_package():
    root = Path(importlib.import_module("stratalake").__file__).parent
    others = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts]
    assert others and not [p for p in others if "stratalake.llm" in p.read_text() or "import llm" in p.read_text()]

"""A few registered queries against their SQL; ``tools/compare.py`` runs them all."""

import os
import sys

import pytest

import __spark_entry__ as entry

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "tools"))
SF = "/root/testdata/sf0.001"
NAMES = ["monthly_sentiment", "clean_audit", "box_stats", "oversample", "load_outcome", "tfidf"]


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not there")
@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, name):
    from compare import compare, connect

    ok, text = compare(connect(SF), spark, SF, name, entry.queries()[name],
                       entry.oracle_sql()[name])
    assert ok, text


def test_every_query_is_registered_once():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) > 100


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not there")
@pytest.mark.parametrize("name", ["read_raw_reviews", "read_clean_sources"])
def test_reviews_are_read_from_files_of_all_rows(spark, name):
    from compare import compare, connect

    df = entry.queries()[name](spark, SF)
    assert df.inputFiles() and not any(SF in f for f in df.inputFiles())
    assert df.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    ok, text = compare(connect(SF), spark, SF, name, entry.queries()[name],
                       entry.oracle_sql()[name])
    assert ok, text


@pytest.mark.skipif(not os.path.exists("/root/testdata/sf0.1"), reason="test tables not there")
def test_sample_is_of_three_thousand_reviews(spark):
    df = entry.queries()["sample_n"](spark, "/root/testdata/sf0.1")
    assert "review_id" in df.columns and df.count() == 3000
    assert "rv" in entry.oracle_sql()["sample_n"] and "LIMIT 3000" in entry.oracle_sql()["sample_n"]


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not there")
def test_a_second_load_reads_the_texts_once(spark):
    df = entry.queries()["insert_new"](spark, SF)
    assert df.inputFiles() and not any("documents" in f for f in df.inputFiles())


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not there")
def test_loads_are_written_small(spark):
    from reviewloom.registry import views as V

    files = V.warehouse(spark, SF)["reviews"].inputFiles()
    assert files and all(".zstd." in f for f in files)


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not there")
def test_scaling_measures_the_texts_once(spark):
    from compare import compare, connect

    df = entry.queries()["apply_scaler"](spark, SF)
    assert df.inputFiles() and not any(SF in f for f in df.inputFiles())
    ok, text = compare(connect(SF), spark, SF, "apply_scaler", entry.queries()["apply_scaler"],
                       entry.oracle_sql()["apply_scaler"])
    assert ok, text


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not there")
def test_orders_meet_no_texts(spark):
    from reviewloom.registry import views as V

    files = V.reviews(spark, SF).inputFiles()
    assert any("documents" in f for f in files) and not any("orders" in f for f in files)


def test_a_platform_without_rows_is_an_empty_table(spark, tmp_path):
    from reviewloom.registry import views as V

    for name in ("documents", "orders", "labels"):
        spark.createDataFrame([], V.TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    for path, _ in V.load_files(spark, str(tmp_path), f"{tmp_path}/in"):
        assert spark.read.parquet(path).isEmpty()


def test_splits_are_written_small(spark, tmp_path):
    from reviewloom.sources.writers import write_splits

    write_splits(spark.createDataFrame([("train", 1)], "split string, n int"), f"{tmp_path}/s")
    assert all(".zstd." in f for f in spark.read.parquet(f"{tmp_path}/s").inputFiles())


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not there")
def test_branches_of_the_report_read_one_table(spark):
    files = entry.queries()["feature_report"](spark, SF).inputFiles()
    for name in ("documents", "labels", "orders", "facts"):
        assert files and not any(name in f for f in files)


@pytest.mark.skipif(not os.path.exists(SF), reason="test tables not there")
@pytest.mark.parametrize("most, join", [(1 << 20, "BroadcastHashJoin"), (10, "ShuffledHashJoin")])
def test_order_facts_are_in_the_driver_only_if_few(spark, monkeypatch, most, join):
    from compare import compare, connect

    from reviewloom.operators import tables
    from reviewloom.registry import views as V

    monkeypatch.setattr(tables, "BROADCAST_ROWS", most)
    reviews = V.reviews(spark, SF, tables.off_driver)
    assert join in reviews._jdf.queryExecution().executedPlan().toString()
    ok, text = compare(connect(SF), spark, SF, "feature_report", entry.queries()["feature_report"],
                       entry.oracle_sql()["feature_report"])
    assert ok, text

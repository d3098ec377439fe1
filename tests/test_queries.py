"""Registered queries against their DuckDB oracles at sf0.001 (one or two
per survey section; tools/oracle_check.py runs them all)."""

import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF001
from tools.oracle_check import TABLES, frame_hash

KEYS = ["accuracy_micro", "predict_proba", "select_features_exclude", "stratified_kfold", "ratio_split",
        "classification_report", "stream_fingerprint", "power_yeo_johnson", "outlier_hard_clip",
        "bin_by_rank_boundaries", "class_groups", "ensemble_expand", "score_kernel", "ragged_unpack",
        "rebatch_exact", "chunk_balanced", "ledger_state", "parse_header_driven", "extract_unit_values",
        "scan_json_array", "file_inventory", "stream_ticks", "udtf_file_to_rows", "join_item_lookup"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    s = E.queries()[key](spark, SF001).toPandas()
    d = con.execute(E.oracle_sql()[key]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert frame_hash(s)[0] == frame_hash(d)[0]


def test_every_query_has_kind():
    from tessera.plans.registry import KIND, QUERIES
    assert set(QUERIES) == set(KIND) <= set(E.queries())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert rows and set(df.columns) == {"n", "correct", "accuracy"}


def test_stream_equals_batch(spark):
    """Scoring files as a stream (availableNow) gives the batch predictions."""
    s = E.queries()["stream_score_files"](spark, SF001)
    b = E.queries()["predict_labels"](spark, SF001)
    assert s.count() == b.count()
    assert s.exceptAll(b).count() == 0

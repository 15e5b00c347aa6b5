"""Named queries against their check SQL, and rules every query obeys."""

import os
import re
import subprocess
import sys
from pathlib import Path

import pytest

import harness
from sensorqc import catalog

ROOT = Path(__file__).resolve().parents[1]
DATA = "/root/testdata/sf0.001"
catalog.load()
SAMPLE = [
    "g02_pad_grid", "g05_rolling7", "g10_interpolate_gap", "n14_step_shift", "s05_instrument_log", "s15_preferred_tier", "j03_join_visits",
    "j16_asof_join", "f07_sv_window", "f17_anomaly_window", "f20_time_drift", "f28_network_check", "t06_thresholds", "t08_finalise", "c09_final_value",
    "d06_range_selection", "d11_fit_rate", "d16_stitch", "v01_weekly_decision", "v02_box_decision", "p01_lineage", "r01_flag_report", "r18_storms", "r26_alarm_suppression",
    "x02_overlap_combine", "x06_gap_sessions",
]
NAMES = sorted(catalog.ORACLES) if os.environ.get("ALL_QUERIES") else SAMPLE


@pytest.fixture(scope="module")
def con():
    return harness.duck(DATA)


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_matches_check_sql(spark, con, name):
    got = catalog.QUERIES[name](spark, DATA).toPandas()
    assert harness.compare(got, con.execute(catalog.ORACLES[name]).df()) is None


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["j15_metadata_range_join", "n14_step_shift", "v02_box_decision", "r20_standards", "f28_network_check"])
def test_no_pairwise_joins(spark, name):
    plan = catalog.QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")
def test_scan_reads_only_needed_columns(spark):
    plan = catalog.QUERIES["g01_slot_agg"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint,event_type:string,value:double>" in plan


def test_library_never_gathers_rows_on_the_driver():
    for path in (ROOT / "sensorqc").rglob("*.py"):
        text = path.read_text()
        assert not re.search(r"\.collect\(|toPandas\(|crossJoin\(|localCheckpoint|\.rdd\b|toLocalIterator", text), path


def test_import_without_a_session():
    code = "import __spark_entry__ as e; assert len(e.queries()) >= len(e.oracle_sql()) > 200"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=60)

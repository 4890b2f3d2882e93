"""The registered queries against their oracles; CHECK_ALL=1 runs every one of them."""

import os

import pytest

import __spark_entry__ as entry_module
from checks.compare import compare, connect
from checks.registry import ORACLES, QUERIES

SF = os.environ.get("CHECK_SF", "/root/testdata/sf0.001")
SOME = ["nrm_vehicle_frame", "nrm_pack_assembly", "qlt_dedup", "qlt_jump", "blk_process_id", "blk_features_core",
        "fea_rank", "fea_waveform", "sig_arbitrate", "sig_registry_eval", "key_best", "key_resolve", "alg_ap16",
        "alg_ap21", "win_hot_battery", "evl_confusion", "evl_sweep"]
NAMES = sorted(ORACLES) if os.environ.get("CHECK_ALL") else SOME


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test data")
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_oracle(spark, duck, name):
    assert compare(spark, duck, SF, name) is None


def test_contract(spark):
    queries, oracles = entry_module.queries(), entry_module.oracle_sql()
    assert set(oracles) <= set(queries)
    assert set(QUERIES) - set(ORACLES) == {"plan_daily_blocks"}
    df = entry_module.entry(spark)
    assert "max_volt_diff" in df.columns and df.count() > 0

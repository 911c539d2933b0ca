"""Driver contract and the SQL oracle at sf0.01 for every registered key."""

import os
import sys

import pytest

import __spark_entry__ as E

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import compare, duck  # noqa: E402

SF01 = "/root/testdata/sf0.01"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["creationDate", "genre", "count"]
    assert df.count() > 0


def test_every_query_of_the_library_has_an_oracle():
    from cinelake import catalog, oracle
    assert set(catalog.all_queries()) == set(oracle.all_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF01)


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, key):
    res = compare(spark, con, SF01, key, E.queries()[key], E.oracle_sql().get(key))
    assert res["status"] in ("exact", "approx"), res


def test_bench_prints_one_json_line():
    import json
    import subprocess
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, BENCH_SF_DIR="/root/testdata/sf0.001", BENCH_KEYS="b03_writer_box_office",
               BENCH_ZONE="0", BENCH_WARMUP="0", BENCH_CPUS="2")
    out = subprocess.run([sys.executable, os.path.join(root, "bench.py")], env=env, capture_output=True,
                         text=True, timeout=600, check=True).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1
    result = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(result)
    assert result["unit"] == "sec" and result["sf"] == 0.001 and result["failed"] == []


def test_bench_times_every_key(monkeypatch):
    import bench
    monkeypatch.delenv("BENCH_KEYS", raising=False)
    assert bench.chosen({"b01": None, "pipeline": None}) == ["b01", "pipeline"]

import math
import os
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
from stepledger.plans import registry  # noqa: E402

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 5) + 0.0
    return value


def bag(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = registry.QUERIES[name](spark, FOLDER)
    got = bag(frame.columns, frame.collect())
    assert sum(got[1].values()) > 0
    if name in registry.ORACLE_SQL:
        result = duck.execute(registry.ORACLE_SQL[name])
        want = bag([d[0] for d in result.description], result.fetchall())
        assert got[0] == want[0]
        assert got[1] == want[1], (list((got[1] - want[1]).items())[:3], list((want[1] - got[1]).items())[:3])


def test_all_kinds_of_damage_occur(spark):
    damage = {r["problem"] for r in registry.QUERIES["envelope_check"](spark, FOLDER).select("problem").distinct().collect()}
    assert damage == {"no_think", "bad_json", "missing_keys", "bad_version", "unknown_method", "fine"}
    modes = {r["subscore"] for r in registry.QUERIES["failure_modes"](spark, FOLDER).collect()}
    assert {"parse", "schema", "precondition_met", "transition_valid"} <= modes


def test_existing_by_seed_grades_once(spark):
    plan = registry.QUERIES["existing_by_seed"](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 1 and "Join" not in plan

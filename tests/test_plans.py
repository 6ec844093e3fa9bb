"""What should stay in the JVM does, and filters reach the scan."""

import pytest

from tessella import registry
from tests.compare import DATA

NATIVE = [n for n in sorted(registry.queries()) if n.startswith(("X", "F", "W", "O", "D1", "D2_content", "U1", "M1", "C1_", "C2_", "C3")) or n[:3] in ("A1_", "A2_", "A3_", "A4_", "A6_", "A8_", "J1_", "J2_", "J3_", "J5_")]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NATIVE)
def test_no_python(spark, name):
    assert "Python" not in (text := plan(registry.queries()[name](spark, DATA))) and "MapIn" not in text


@pytest.mark.parametrize("name", ["X7_word_count", "C1_heading_chunk_123", "C3_rule_chunk", "F5_path_exclude"])
def test_no_shuffle(spark, name):
    assert "Exchange" not in plan(registry.queries()[name](spark, DATA))


def test_column_pruning_and_top_k(spark):
    text = plan(registry.queries()["F5_path_exclude"](spark, DATA))
    assert "ReadSchema: struct<file_id:bigint,file_path:string>" in text
    assert "TakeOrderedAndProject" in plan(registry.queries()["O1_global_top_k"](spark, DATA))
    assert "WindowGroupLimit" in plan(registry.queries()["W3_top_k_per_group"](spark, DATA))

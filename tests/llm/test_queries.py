import re
from pathlib import Path

import pytest

from tessella.llm import queries as Q
from tests.compare import DATA, same, tables

ROOT = Path(__file__).parents[2]


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_sql(spark, name):
    same(Q.queries()[name](spark, DATA).toPandas(), tables().sql(Q.oracle_sql()[name]).df())


def test_nothing_else_imports_the_package():
    for path in (ROOT / "tessella").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"tessella[. ]+(?:import )?llm", path.read_text()), path


def test_columns(spark):
    columns = {"p2_found": ["file_id"], "p4_found": ["tab_a", "id_a", "tab_b", "id_b"], "p5_found": ["file_id", "fn_line"], "p6_ids": ["doc_id", "ids"]}
    for name, want in columns.items():
        assert Q.queries()[name](spark, DATA).columns == want

import os

import pytest

from compare import DATA, connect, same
from corpusmill.llm.queries import QUERIES, SQL

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, name):
    same(spark, connect(), QUERIES[name], SQL[name])


COLUMNS = {"p1_found": ["id", "verdict", "domain"], "p2_found": ["target_id"], "p5_found": ["paper_id", "thematic_area"], "p6_found": ["doc_id"], "p7_found": ["source"], "p8_found": ["doc_id"]}


@pytest.mark.parametrize("name", ["p1_found", "p5_found", "p8_found", "p1_reliability", "p2_sample", "p5_composition", "p6_fill", "p7_mix", "p8_rates"])
def test_query_runs(spark, name):
    df = QUERIES[name](spark, DATA)
    assert df.count() >= (0 if name == "p8_found" else 1)
    assert name not in COLUMNS or df.columns == COLUMNS[name]

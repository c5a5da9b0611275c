"""The user's SQL with bound arguments agrees with the DataFrame operators."""

import os

import pytest

from bibliospark.plans import pipelines, warehouse_queries, warehouse_sql
from bibliospark.schemas import PUBLICATION
from bibliospark.sources import read_indexed_json
from tests import fixtures as fx


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    path = fx.write_indexed_json(os.path.join(tmp_path_factory.mktemp("wh"), "p.json"))
    t = pipelines.normalise(pipelines.clean_publications(read_indexed_json(spark, path, PUBLICATION)),
                            fx.doi_lookup(spark), fx.gender_lookup(spark))
    w = pipelines.build_warehouse(t)
    warehouse_sql.register(w)
    return w


def test_sql_equals_dataframe(spark, wh):
    sql = """SELECT journal_name, count(*) AS total_publications FROM fact_publications JOIN dim_journal USING (journal_id)
             GROUP BY ALL ORDER BY 2 DESC, 1 LIMIT :most"""
    want = [tuple(r) for r in warehouse_queries.sample_queries(wh)["sq2_top_journals"].collect()]
    assert [tuple(r) for r in warehouse_sql.ask(spark, sql, most=3).collect()] == want


def test_bound_arguments(spark, wh):
    sql = "SELECT publication_id FROM fact_publications WHERE title LIKE :pattern AND publication_id < :bound"
    assert [r[0] for r in warehouse_sql.ask(spark, sql, pattern="%Repeated%", bound=100).collect()] == [12]
    assert warehouse_sql.ask(spark, sql, pattern="' OR 1 = 1 --", bound=100).count() == 0

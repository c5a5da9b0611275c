"""Plan-shape regressions for every registered query.

No query may plan a cartesian product, a nested-loop join or Python
evaluation per row.  A single-partition exchange may only feed a keyless
(global) aggregate, whose final stage sees one partial row per task; that
holds for the jobs that run while a query is built as well."""

import contextlib
import io

import pytest
from pyspark.sql.classic.dataframe import DataFrame
from pyspark.sql.readwriter import DataFrameWriter

from bibliospark.plans.driver_queries import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def _plan(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return [line for line in buf.getvalue().splitlines() if line.strip()]


def _single_partition_parents(lines):
    parents = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            parents.append(lines[i - 1])
    return parents


@pytest.fixture()
def plans(monkeypatch):
    """Plans of everything that is checkpointed or written while a query is built."""
    seen = []
    checkpoint, parquet = DataFrame.checkpoint, DataFrameWriter.parquet

    def recorded_checkpoint(self, eager=True):
        seen.append(_plan(self))
        return checkpoint(self, eager)

    def recorded_parquet(self, path, *args, **options):
        seen.append(_plan(self._df))
        return parquet(self, path, *args, **options)

    monkeypatch.setattr(DataFrame, "checkpoint", recorded_checkpoint)
    monkeypatch.setattr(DataFrameWriter, "parquet", recorded_parquet)
    return seen


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_shapes_of_eager_and_final_plans(spark, plans, name):
    plans.append(_plan(QUERIES[name](spark, SF)))
    for lines in plans:
        assert not [f for f in FORBIDDEN if f in "\n".join(lines)]
        for parent in _single_partition_parents(lines):
            assert "Aggregate(keys=[]" in parent, parent


def test_duplicates_take_two_scans(spark, plans):
    plans.append(_plan(QUERIES["drop_all_duplicates"](spark, SF)))
    scans = [line for lines in plans for line in lines if "FileScan" in line and "documents.parquet" in line]
    assert len(scans) == 2


def test_name_match_has_few_exchanges(spark):
    lines = _plan(QUERIES["author_bridge"](spark, SF))
    assert sum("Exchange hashpartitioning" in line for line in lines) <= 8

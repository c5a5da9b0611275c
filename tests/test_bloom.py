"""Key filters: exact joins, rate of false positives, size bound, plans."""

import contextlib
import io
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bibliospark.operators import KeyFilter, filtered_in, filtered_not_in, key_filter, row_not_in

ROWS = "id long, a long, b string"


def _tables(spark, seed):
    rng = random.Random(seed)

    def tuples(n):
        return [(rng.choice([None, *range(12)]), rng.choice([None, "", "x", "y", "zz"])) for _ in range(n)]

    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(tuples(200))], ROWS)
    return df.unionByName(df.limit(20)), spark.createDataFrame(tuples(25), "a long, b string")


def _rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("max_blocks", [1, 1 << 18])
def test_joins_are_exact(spark, seed, max_blocks):
    df, keys = _tables(spark, seed)
    kept = key_filter(keys, ["a", "b"], max_blocks=max_blocks)
    known = {tuple(r) for r in keys.collect()}
    out, inside = _rows(filtered_not_in(df, keys, ["a", "b"], kept)), _rows(filtered_in(df, keys, ["a", "b"], kept))
    assert inside == Counter({r: n for r, n in _rows(df).items() if r[1:] in known})
    assert out == _rows(df) - inside == _rows(row_not_in(df, keys, ["a", "b"]))


def test_empty_sides(spark):
    df, keys = _tables(spark, 9)
    none = key_filter(keys.limit(0), ["a", "b"])
    assert _rows(filtered_not_in(df, keys.limit(0), ["a", "b"], none)) == _rows(df)
    assert not filtered_in(df, keys.limit(0), ["a", "b"], none).count()
    assert not filtered_not_in(df.limit(0), keys, ["a", "b"], key_filter(keys, ["a", "b"])).count()


def test_clashing_names_and_other_key_names(spark):
    df, keys = _tables(spark, 4)
    renamed = keys.withColumnsRenamed({"a": "id", "b": "a"})
    kept = key_filter(renamed, ["id", "a"])
    assert _rows(filtered_not_in(df, renamed, ["a", "b"], kept, ["id", "a"])) == _rows(row_not_in(df, keys, ["a", "b"]))


def test_types_must_agree(spark):
    kept = key_filter(spark.range(3).selectExpr("cast(id as int) AS k"), ["k"])
    with pytest.raises(ValueError, match="cast them first"):
        kept.probed(spark.range(3).toDF("k"), ["k"])


def test_few_false_positives_and_none_missed(spark):
    kept = key_filter(spark.range(0, 60_000).toDF("k"), ["k"])
    seen = kept.probed(spark.range(0, 260_000).toDF("k"), ["k"]).filter("_bs_maybe")
    counts = {r[0]: r[1] for r in seen.groupBy(F.col("k") < 60_000).count().collect()}
    assert counts[True] == 60_000
    assert counts.get(False, 0) < 2_000   # 1 % of the 200,000 others


def test_size_is_bounded(spark):
    kept = key_filter(spark.range(0, 60_000).toDF("k"), ["k"], max_blocks=100)
    assert kept.n_blocks == 100 and kept.blocks.count() <= 100


def test_saved_with_its_table_and_extended(spark, tmp_dir):
    first, later = spark.range(0, 500).toDF("k"), spark.range(500, 700).toDF("k")
    key_filter(first, ["k"]).save(f"{tmp_dir}/filter")
    loaded = KeyFilter.load(spark, f"{tmp_dir}/filter")
    rows = spark.range(0, 2_000).toDF("k")
    assert filtered_not_in(rows, first, ["k"], loaded).count() == 1_500
    more = loaded.extended(later, ["k"])
    assert filtered_not_in(rows, first.unionByName(later), ["k"], more).count() == 1_300


def test_saved_filter_of_no_keys(spark, tmp_dir):
    key_filter(spark.range(0).toDF("k"), ["k"]).save(f"{tmp_dir}/filter")
    loaded = KeyFilter.load(spark, f"{tmp_dir}/filter")
    assert loaded.n_blocks == 1 and loaded.types == ("bigint",)
    assert not loaded.probed(spark.range(50).toDF("k"), ["k"]).filter("_bs_maybe").count()


def test_rows_ruled_out_are_not_shuffled(spark, tmp_dir):
    key_filter(spark.range(0, 500).toDF("k"), ["k"]).save(f"{tmp_dir}/filter")
    kept = KeyFilter.load(spark, f"{tmp_dir}/filter")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        kept.probed(spark.range(0, 2_000).toDF("k"), ["k"]).filter("NOT _bs_maybe").explain()
    plan = buf.getvalue()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan

"""Notebook star questions (NQ1-NQ3) and table writers."""

import datetime as dt
import os
import random
from collections import defaultdict

from pyspark.sql import functions as F

from bibliospark.operators import date_dimension, join_star, sample_n
from bibliospark.plans.warehouse_queries import star_stats
from bibliospark.schemas import AUTHORS
from bibliospark.sources import append_conformed, load_staging, save_table, write_csv_table


def _star(spark):
    rng = random.Random(11)
    origins = ["forum /a/", "news site", "forum /b/", None]
    details = [(i, rng.choice(origins)) for i in range(20)]
    scores = [(i, rng.random()) for i in range(5)]
    start = dt.date(2019, 12, 25)
    facts = []
    for _ in range(300):
        d = start + dt.timedelta(days=rng.randint(0, 30))
        key = int(d.strftime("%Y%m%d")) if rng.random() > 0.05 else 99999999   # some dangling date keys
        facts.append((rng.random(), float(rng.randint(0, 100)), key, rng.randint(0, 21), rng.randint(0, 4)))
    fact = spark.createDataFrame(facts, "tag_profanity_score double, popularity_score double, d_date_key int, "
                                        "d_details_key int, d_vprof_key int")
    date_dim = date_dimension(spark, dt.date(2019, 12, 1), 62)
    det = spark.createDataFrame(details, "d_details_id int, details_origin string")
    sc = spark.createDataFrame(scores, "d_vprof_id int, vision_score double")
    return facts, details, fact, date_dim, det, sc


def _brute(facts, details, key_of, origin_like=None):
    origin = dict(details)
    groups = defaultdict(list)
    for tag, pop, dkey, det, _ in facts:
        if origin_like is not None:
            o = origin.get(det)
            if o is None or "forum" not in o:
                continue
        groups[key_of(dkey)].append((tag, pop))
    return {k: (round(sum(t for t, _ in v) / len(v), 9), round(sum(p for _, p in v) / len(v), 9), len(v))
            for k, v in groups.items()}


# the star's own column names
KEYS = (("d_date_key", "date_dim_id"), ("d_details_key", "d_details_id"), ("d_vprof_key", "d_vprof_id"))
METRICS = {"tag_profanity_score": "avg_profanity_score", "popularity_score": "avg_popularity_score"}


def notebook_join_all(fact, *dims):
    return join_star(fact, [(d, fk, dk) for d, (fk, dk) in zip(dims, KEYS)])


def notebook_by(fact, date_dim, det, sc, group_col, origin_like=None):
    dims = [(d, fk, dk) for d, (fk, dk) in zip((date_dim, det, sc), KEYS)]
    where = F.col("details_origin").like(origin_like) if origin_like is not None else None
    return star_stats(fact, dims, group_col, METRICS, "meme_count", where=where)


def _iso_dow(key):
    if key == 99999999:
        return None
    return dt.datetime.strptime(str(key), "%Y%m%d").isoweekday()


def test_notebook_questions(spark):
    facts, details, fact, date_dim, det, sc = _star(spark)
    allj = notebook_join_all(fact, date_dim, det, sc)
    assert allj.count() == len(facts)                      # left joins keep every fact
    assert {"year_actual", "details_origin", "vision_score"} <= set(allj.columns)

    def got(df, col):
        return {r[col]: (round(r.avg_profanity_score, 9), round(r.avg_popularity_score, 9), r.meme_count)
                for r in df.collect()}

    by_year = got(notebook_by(fact, date_dim, det, sc, "year_actual"), "year_actual")
    want_year = _brute(facts, details, lambda k: None if k == 99999999 else int(str(k)[:4]))
    assert by_year == want_year
    by_dow = got(notebook_by(fact, date_dim, det, sc, "day_of_week", origin_like="%forum%"), "day_of_week")
    assert by_dow == _brute(facts, details, _iso_dow, origin_like="%forum%")
    counts = [r.meme_count for r in notebook_by(fact, date_dim, det, sc, "year_actual").collect()]
    assert counts == sorted(counts, reverse=True)           # ordered by count desc
    assert sample_n(allj, 25, 1, ["tag_profanity_score", "popularity_score"]).count() == 25


def test_staging_and_tables(spark, tmp_dir):
    df = spark.createDataFrame([(0, "Smith", "John "), (1, "Li", "Wei")], AUTHORS)
    csv = os.path.join(tmp_dir, "authors_csv")
    write_csv_table(df, csv)
    staged = load_staging(spark, "authors_import", csv, AUTHORS)
    assert spark.table("authors_import").count() == 2 and staged.exceptAll(df).count() == 0
    out = os.path.join(tmp_dir, "dim_author")
    save_table(staged, "dim_author", path=out)
    save_table(staged, "dim_author", path=out)             # overwrite: rerun is idempotent
    assert spark.read.parquet(out).count() == 2
    loc = os.path.join(tmp_dir, "bridge_tbl")
    spark.sql(f"CREATE TABLE bridge_t (publication_id INT, author_id INT) USING parquet LOCATION '{loc}'")
    src = spark.createDataFrame([(5, 7)], "author_id bigint, publication_id bigint")
    from pyspark.sql.types import IntegerType, StructField, StructType
    append_conformed(src, "bridge_t", StructType([StructField("publication_id", IntegerType()),
                                                  StructField("author_id", IntegerType())]))
    assert [(r.publication_id, r.author_id) for r in spark.table("bridge_t").collect()] == [(7, 5)]
    spark.sql("DROP TABLE bridge_t")

"""Streaming ingest equals the batch row-local steps."""

import json
import os

from bibliospark.functions import first_last
from bibliospark.operators import drop_columns, min_length, nullify
from bibliospark.schemas import PUBLICATION
from bibliospark.sources import read_indexed_json
from bibliospark.streaming import start_clean_stream
from tests import fixtures as fx


def test_clean_stream_matches_batch(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    items = sorted(fx.PUBLICATIONS.items(), key=lambda kv: int(kv[0]))
    for part in range(2):   # two files arriving
        with open(os.path.join(src, f"part-{part}.jsonl"), "w", encoding="utf-8") as f:
            for k, r in items[part::2]:
                f.write(json.dumps({**r, "id": int(k)}, ensure_ascii=False) + "\n")
    q = start_clean_stream(spark, src, PUBLICATION, os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"))
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(tmp_dir, "sink"))

    path = fx.write_indexed_json(os.path.join(tmp_dir, "pubs.json"))
    batch = min_length(drop_columns(read_indexed_json(spark, path, PUBLICATION), ["abstract", "update_date", "license"]),
                       "title", 35)
    f, l = first_last("versions", "created")
    batch = nullify(batch.withColumns({"publ_date": f, "publ_lastupdate": l}))
    cols = sorted(batch.columns)
    assert sorted(got.columns) == cols
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(got.select(cols)).count() == 0


def test_enrich_stream_matches_batch(spark, tmp_dir):
    from bibliospark.plans import pipelines
    src = os.path.join(tmp_dir, "src")
    os.makedirs(src)
    with open(os.path.join(src, "part-0.jsonl"), "w", encoding="utf-8") as f:
        for k, r in fx.PUBLICATIONS.items():
            f.write(json.dumps({**r, "id": int(k)}, ensure_ascii=False) + "\n")
    lookup = fx.doi_lookup(spark)
    q = start_clean_stream(spark, src, PUBLICATION, os.path.join(tmp_dir, "sink"), os.path.join(tmp_dir, "ckpt"),
                           doi_lookup=lookup)
    q.awaitTermination(120)
    got = spark.read.parquet(os.path.join(tmp_dir, "sink"))
    path = fx.write_indexed_json(os.path.join(tmp_dir, "pubs.json"))
    raw = read_indexed_json(spark, path, PUBLICATION)
    batch = min_length(drop_columns(raw, ["abstract", "update_date", "license"]), "title", 35)
    f_, l_ = first_last("versions", "created")
    batch = pipelines.enrich_publications(batch.withColumns({"publ_date": f_, "publ_lastupdate": l_}), lookup)
    cols = sorted(batch.columns)
    assert sorted(got.columns) == cols
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(got.select(cols)).count() == 0

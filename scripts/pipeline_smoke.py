"""Run the four stages end to end on publication records derived from the
shared `documents` table (one record per document), in a fresh scratch folder.

Authors and submitters are built from each text's words, DOI metadata from
`labels`, genders from the first names.  Prints one JSON line with the
record count, seconds per stage and the audit counts.

usage: python scripts/pipeline_smoke.py [sf_dir] [match]
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, ".")
from pyspark.sql import functions as F  # noqa: E402

from bibliospark.plans.run import run_pipelines  # noqa: E402
from bibliospark.sources import TableStore  # noqa: E402
from bibliospark.session import get_session  # noqa: E402

sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
match = sys.argv[2] if len(sys.argv) > 2 else "contains"
scratch = tempfile.mkdtemp(prefix="pipeline-run-")
spark = get_session("local[8]", **{"spark.sql.shuffle.partitions": "16", "spark.ui.showConsoleProgress": "false",
                                   "spark.checkpoint.dir": os.path.join(scratch, "ckpt")})
docs = spark.read.parquet(f"{sf}/documents.parquet")
w = F.split(F.regexp_replace(F.col("text"), r"[^\p{L} ]", ""), " +")
word = lambda i: F.coalesce(F.try_element_at(w, F.lit(i)), F.lit(""))
pubs = docs.select(
    F.col("doc_id").alias("id"),
    F.concat_ws(" ", word(2), word(1)).alias("submitter"),
    F.lit("authors").alias("authors"),
    F.substring("text", 1, 80).alias("title"),
    F.when(F.col("doc_id") % 7 == 0, F.lit("None")).otherwise(F.col("source")).alias("comments"),
    F.concat(F.lit("10.1/"), F.col("doc_id").cast("string")).alias("doi"),
    F.col("lang").alias("categories"),
    F.array(F.struct(F.lit("v1").alias("version"),
                     F.lit("Mon, 2 Apr 2007 19:18:42 GMT").alias("created"))).alias("versions"),
    F.array(F.array(word(1), word(2)), F.array(word(3), word(4)), F.array(word(5), word(6))).alias("authors_parsed"),
)
src = os.path.join(scratch, "pubs.parquet")
pubs.write.parquet(src)
labels = spark.read.parquet(f"{sf}/labels.parquet")
lookup = labels.join(docs.select("doc_id", "lang", "source"), "doc_id").select(
    F.concat(F.lit("10.1/"), F.col("doc_id").cast("string")).alias("doi"),
    (F.col("quality") * 10 + F.col("toxic")).cast("bigint").alias("reference_count"),
    F.array("lang").alias("discipline"), F.col("source").alias("publication_type"),
    F.concat(F.lit("Journal "), F.col("lang")).alias("journal"))
doi = os.path.join(scratch, "doi.parquet")
lookup.write.parquet(doi)
first = spark.read.parquet(src).select(F.regexp_extract("submitter", r"^(\S+)", 1).alias("firstname")).distinct()
gender = os.path.join(scratch, "gender.parquet")
first.select("firstname", F.when(F.length("firstname") % 3 == 0, "female")
             .when(F.length("firstname") % 3 == 1, "male").otherwise("unknown").alias("gender")).write.parquet(gender)

t0 = time.perf_counter()
stages: dict = {}
audits = run_pipelines(spark, src, doi, gender, os.path.join(scratch, "out"), match=match, timings=stages)
total = time.perf_counter() - t0
store = TableStore(spark, os.path.join(scratch, "out"))
counts = {t: store.read(f"{p}/{t}").count()
          for p, t in [("p1", "publications"), ("p2", "authors"), ("p2", "bridge"), ("warehouse", "fact_publications"),
                       ("graph", "edges")]}
print(json.dumps({"records": pubs.count(), "match": match, "seconds": round(total, 2), "stages": stages,
                  "rows": counts,
                  "audits": audits}))

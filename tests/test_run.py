"""The stage runner over the fixture: every stage written and readable."""

import os

import pytest

from bibliospark.operators.audit import IntegrityError
from bibliospark.plans.run import run_pipelines
from bibliospark.schemas import PUBLICATION
from bibliospark.sources import TableStore, read_indexed_json, write_documents
from tests import fixtures as fx


def _source(spark, folder):
    """The records, converted once from the single JSON object to JSONL."""
    raw = read_indexed_json(spark, fx.write_indexed_json(os.path.join(folder, "pubs.json")), PUBLICATION)
    path = os.path.join(folder, "pubs.jsonl")
    write_documents(raw, path, fmt="json")
    return path


def test_run_pipelines(spark, tmp_dir):
    src = _source(spark, tmp_dir)
    doi = os.path.join(tmp_dir, "doi")
    fx.doi_lookup(spark).write.parquet(doi)
    gender = os.path.join(tmp_dir, "gender")
    fx.gender_lookup(spark).write.parquet(gender)
    out = os.path.join(tmp_dir, "out")
    audits = run_pipelines(spark, src, doi, gender, out)
    assert audits["fact_pk"] == 0 and audits["journal_name"] == 1 and audits["bridge_publication_fk"] == 0
    store = TableStore(spark, out)
    for name in ["p1/publications", "p2/bridge", "warehouse/fact_publications", "graph/edges"]:
        assert store.read(name).count() > 0
    summary = {r.audit: r.violations for r in store.read("audit_summary", "json").collect()}
    assert summary == audits
    # rerun over the same folder is idempotent
    assert run_pipelines(spark, src, doi, gender, out, max_publications=3)["fact_pk"] == 0
    assert store.read("warehouse/fact_publications").count() == 3
    # the versions before are gone, and so are the intermediates
    assert len(os.listdir(os.path.join(out, "_runs"))) == 1
    scratch = spark.sparkContext.getCheckpointDir().removeprefix("file:")
    assert not [f for f in os.listdir(scratch) if f.startswith(("match-", "name-"))]


def test_a_run_that_dies_leaves_the_version_before(spark, tmp_dir, monkeypatch):
    src, doi, gender = _inputs(spark, tmp_dir)
    out = os.path.join(tmp_dir, "out")
    run_pipelines(spark, src, doi, gender, out)
    store = TableStore(spark, out)
    before = store.current()
    want = store.read("warehouse/fact_publications").collect()

    def dies(tables):
        raise RuntimeError("lost")

    monkeypatch.setattr("bibliospark.plans.pipelines.build_graph", dies)
    with pytest.raises(RuntimeError, match="lost"):
        run_pipelines(spark, src, doi, gender, out, max_publications=2)
    assert store.current() == before and store.read("warehouse/fact_publications").collect() == want
    monkeypatch.undo()
    assert len(os.listdir(os.path.join(out, "_runs"))) == 2   # what the dead run left
    run_pipelines(spark, src, doi, gender, out, max_publications=2)
    assert store.read("warehouse/fact_publications").count() == 2
    assert len(os.listdir(os.path.join(out, "_runs"))) == 1


def test_two_runs_do_not_share_a_version(spark, tmp_dir):
    one, two = TableStore(spark, tmp_dir), TableStore(spark, tmp_dir)
    with pytest.raises(FileNotFoundError):
        one.current()
    one.write("t", spark.range(3))
    assert one.commit() == 1
    two._numbers = lambda: []   # it has looked before the other was done
    with pytest.raises(RuntimeError, match="another run"):
        two.commit()
    assert two.__class__(spark, tmp_dir).read("t").count() == 3


def test_bucketed_warehouse_joins_without_shuffle(spark, tmp_dir):
    import contextlib
    import io
    src = _source(spark, tmp_dir)
    doi = os.path.join(tmp_dir, "doi")
    fx.doi_lookup(spark).write.parquet(doi)
    gender = os.path.join(tmp_dir, "gender")
    fx.gender_lookup(spark).write.parquet(gender)
    run_pipelines(spark, src, doi, gender, os.path.join(tmp_dir, "out"), buckets=4)
    # qualified names: temp views of the same name (other tests) must not shadow the tables
    joined = spark.table("spark_catalog.default.fact_publications").join(
        spark.table("spark_catalog.default.bridge_author_publications"), "publication_id")
    buf = io.StringIO()
    # warehouse-sized tables exceed the broadcast threshold; check that path
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with contextlib.redirect_stdout(buf):
            joined.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in buf.getvalue() and "SortMergeJoin" in buf.getvalue()
    assert joined.count() == TableStore(spark, os.path.join(tmp_dir, "out")).read("p2/bridge").count()
    for t in ("fact_publications", "bridge_author_publications", "dim_versions", "dim_author", "dim_gender"):
        spark.sql(f"DROP TABLE spark_catalog.default.{t}")


def test_cli(spark, tmp_dir, capsys):
    import json

    from bibliospark.plans.run import main
    src = _source(spark, tmp_dir)
    doi = os.path.join(tmp_dir, "doi")
    fx.doi_lookup(spark).write.parquet(doi)
    gender = os.path.join(tmp_dir, "gender.csv")
    from bibliospark.sources import write_csv_table
    write_csv_table(fx.gender_lookup(spark), gender)
    main(["--source", src, "--doi-lookup", doi, "--gender-lookup", gender, "--out", os.path.join(tmp_dir, "o"),
          "--max-publications", "5"])
    audits = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert audits["fact_pk"] == 0
    assert TableStore(spark, os.path.join(tmp_dir, "o")).read("warehouse/fact_publications").count() == 5


def _inputs(spark, folder):
    doi, gender = os.path.join(folder, "doi"), os.path.join(folder, "gender")
    fx.doi_lookup(spark).write.parquet(doi)
    fx.gender_lookup(spark).write.parquet(gender)
    return _source(spark, folder), doi, gender


def test_strict_run_fails_on_a_duplicate_key(spark, tmp_dir):
    src, doi, gender = _inputs(spark, tmp_dir)
    twice = os.path.join(tmp_dir, "twice.jsonl")
    rows = spark.read.json(src)
    # the same id under another title: the fact keeps one of them, the authors' ids stay unique, the audit is clean
    rows.write.json(twice)
    assert run_pipelines(spark, twice, doi, gender, os.path.join(tmp_dir, "ok"), strict=True)["fact_pk"] == 0
    from bibliospark.plans import pipelines
    bad = {"dim_author": spark.createDataFrame([(1, "S", "N"), (1, "T", "N")], "author_id long, Surname string, Names string")}
    wh = {n: TableStore(spark, os.path.join(tmp_dir, "ok")).read(f"warehouse/{n}") for n in
          ("dim_gender", "dim_journal", "dim_discipline", "dim_publication_type", "fact_publications",
           "bridge_author_publications", "dim_versions")} | bad
    with pytest.raises(IntegrityError):
        pipelines.audit_warehouse(wh, strict=True)


def test_csv_parity_run_leaves_out_empty_names(spark, tmp_dir):
    src, doi, gender = _inputs(spark, tmp_dir)
    read = lambda out: TableStore(spark, os.path.join(tmp_dir, out)).read("p2/bridge").collect()
    run_pipelines(spark, src, doi, gender, os.path.join(tmp_dir, "plain"))
    run_pipelines(spark, src, doi, gender, os.path.join(tmp_dir, "parity"), csv_parity=True)
    authors = {r.author_id: r.Names for r in TableStore(spark, os.path.join(tmp_dir, "parity")).read("p2/authors").collect()}
    assert any(authors[r.author_id] == "" for r in read("plain"))
    assert read("parity") and not any(authors[r.author_id] == "" for r in read("parity"))


def test_json_object_is_read(spark, tmp_dir):
    """The source's own shape, one JSON object, gives what its JSONL form gives."""
    src, doi, gender = _inputs(spark, tmp_dir)
    for name, source in (("a", os.path.join(tmp_dir, "pubs.json")), ("b", src)):
        run_pipelines(spark, source, doi, gender, os.path.join(tmp_dir, name))
    a, b = (TableStore(spark, os.path.join(tmp_dir, n)).read("warehouse/fact_publications") for n in "ab")
    assert a.count() and a.exceptAll(b).count() == 0 == b.exceptAll(a).count()

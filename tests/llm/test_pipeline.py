import re
import shutil
import subprocess
import sys

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline as C
from laketide.llm import decontaminate, exact_dedup, jaccard_join, packing, quality, queries

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "benchmark", "labels", "pages", "embeddings")


def test_registered():
    names = set(E.queries())
    assert {*queries.QUERIES, "pipeline"} <= names and set(queries.ORACLE) <= set(E.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_oracle(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = E.queries()[name](spark, SF)
    res = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(df.columns)
    assert sorted(map(str, map(tuple, df.select(cols).collect()))) == sorted(map(str, res.fetchall()))


def test_stages_against_their_operators(spark):
    """Every stage keeps exactly the rows its operator's own result says, with all columns."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    keep = [lambda d: quality.quality(d, labels).where("predicted = 1"), lambda d: exact_dedup.exact_dedup(d).where("kept"),
            lambda d: jaccard_join.jaccard_join(d).where("doc_id = component_id"),
            lambda d: decontaminate.contaminated_report(d, bench).where("NOT contaminated")]
    assert len(C.STAGES) == 5
    for (name, stage), want in zip(C.STAGES, keep):
        out = stage(spark, docs, SF)
        ids = {r.doc_id for r in want(docs).collect()}
        assert out.columns == docs.columns and {r.doc_id for r in out.select("doc_id").collect()} == ids, name
        assert 0 < len(ids) <= docs.count()
        docs = out
    last = C.run(spark, SF)
    assert sorted(map(tuple, last.collect())) == sorted(map(tuple, packing.pack(docs).collect()))


def test_clean_labelled_documents_stay(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    kept = {r.doc_id for r in C.STAGES[0][1](spark, docs, "/root/testdata/sf0.01").select("doc_id").collect()}
    good = {r.doc_id for r in labels.where("quality = 1").collect()}
    assert len(good & kept) >= 0.99 * len(good)


def test_nasty_rows_and_empty_through_all_stages(spark, nasty, nothing):
    for docs in (nasty, nothing):
        n = docs.count()
        for _, stage in C.STAGES[:-1]:
            docs = stage(spark, docs, SF)
            assert docs.columns == nasty.columns and docs.count() <= n
        assert (C.STAGES[-1][1](spark, docs, SF).count() > 0) == (docs.count() > 0)


def test_entry_imports_without_the_subpackage(tmp_path):
    import os
    repo = os.path.dirname(os.path.abspath(E.__file__))
    shutil.copy(f"{repo}/__spark_entry__.py", tmp_path)
    shutil.copytree(f"{repo}/laketide", tmp_path / "laketide", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; n = set(e.queries()); assert n and n == set(e.oracle_sql()); print(len(n))"
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True,
                         env={**os.environ, "PYTHONPATH": str(tmp_path)})
    assert out.returncode == 0, out.stderr[-2000:]

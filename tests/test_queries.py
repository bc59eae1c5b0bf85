"""Every registered query against its SQL, on the smallest tables."""

import glob
import hashlib
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

duckdb = pytest.importorskip("duckdb")

import __spark_entry__ as E  # noqa: E402
from accesslake.functions.digests import sha3_256  # noqa: E402
from accesslake.operators.hashing import hash_objects  # noqa: E402
from accesslake.sources.listing import list_objects  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_equals_sql(spark, tables, name):
    df = E.queries()[name](spark, SF_DIR)
    columns = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*columns).collect())
    result = tables.sql(E.oracle_sql()[name])
    assert sorted(result.columns) == columns
    names = ", ".join(f'"{c}"' for c in columns)
    assert got == Counter(tables.sql(f"select {names} from ({E.oracle_sql()[name]})").fetchall())
    assert got or name.startswith("batch")


def test_every_sql_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry(spark):
    assert E.entry(spark).count() > 0


def test_digests_of_files(spark):
    """The objects of queries are staged; here the files are given."""
    files = {os.path.basename(p): open(p, "rb").read() for p in glob.glob(f"{SF_DIR}/*.parquet")}
    listed = list_objects(spark, SF_DIR).filter("s3key like '%.parquet'")
    assert {r.s3key: r.bytes for r in listed.collect()} == {k: len(v) for k, v in files.items()}
    hashed = {r.s3key: (r.sha2_256, r.sha3_256) for r in hash_objects(listed).collect()}
    assert hashed == {k: (hashlib.sha256(v).hexdigest(), hashlib.sha3_256(v).hexdigest()) for k, v in files.items()}


def test_sha3_column(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text", sha3_256(F.col("text")).alias("sha3"))
    assert all(r.sha3 == hashlib.sha3_256(r.text.encode()).hexdigest() for r in docs.collect())

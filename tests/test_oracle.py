"""Every query that has SQL gives the rows of its SQL; every query runs on empty tables."""

import datetime
import decimal
import glob
import math
import os

import duckdb
import pytest

from siltstone.plans import queries as Q


def canon(v):
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int | decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v if isinstance(v, str) else str(v)


@pytest.fixture(scope="module")
def db(small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_rows_of_sql(spark, db, small, name):
    df = Q.queries()[name](spark, small)
    columns = sorted(df.columns)
    got = sorted((tuple(map(canon, r)) for r in df.select(*columns).collect()), key=str)
    result = db.execute(Q.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted((tuple(canon(r[i]) for i in at) for r in result.fetchall()), key=str)


@pytest.fixture(scope="module")
def empty(spark, small, tmp_path_factory):
    out = tmp_path_factory.mktemp("empty")
    for f in glob.glob(f"{small}/*.parquet"):
        spark.read.parquet(f).limit(0).write.parquet(f"{out}/{os.path.basename(f)}")
    return str(out)


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - set(Q.oracle_sql())) + ["search_ranked", "keywords_top12", "exact_dedup_canonical"])
def test_empty_tables(spark, empty, name):
    assert Q.queries()[name](spark, empty).count() == 0


@pytest.mark.parametrize("name", sorted(set(Q.queries()) - set(Q.oracle_sql())))
def test_queries_without_sql_run(spark, small, name):
    assert Q.queries()[name](spark, small).count() > 0


@pytest.mark.parametrize("name", ["ioc_matches", "wording_lint", "risk_status", "gate_security"])
def test_scans_of_empty_tables_have_the_samples_only(spark, empty, name):
    assert all(r.doc_id < 0 for r in Q.queries()[name](spark, empty).select("doc_id").collect())


def test_every_rule_occurs(spark, small):
    """No query over the scanner's rules compares nothing with nothing."""
    from siltstone.functions import rules as R

    found = {r.pattern_name for r in Q.queries()["ioc_matches"](spark, small).select("pattern_name").distinct().collect()}
    assert found == {n for n, *_ in (*R.IOC, *R.INSTRUCTIONS)}
    assert {r.description for r in Q.queries()["wording_lint"](spark, small).select("description").distinct().collect()} == {n for n, _ in R.WORDING}
    shown = {c for r in Q.queries()["capabilities"](spark, small).select("capabilities").distinct().collect() for c in r[0].split(",") if c}
    assert shown == {n for n, _ in R.CAPABILITIES}
    assert {r.status for r in Q.queries()["risk_status"](spark, small).select("status").distinct().collect()} == {"malicious", "review", "warn", "pass"}

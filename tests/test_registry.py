"""Every registered query against its SQL twin, on the smallest tables."""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tidequote.plans import oracles, registry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {file.stem} as select * from '{file}'")
    return con


def _canonical(df):
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if df[c].dtype.kind in "iuf":
            df[c] = df[c].astype("float64").round(9)
        else:
            df[c] = df[c].astype(str).replace({"None": "nan", "<NA>": "nan"})
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def test_every_query_has_a_twin():
    assert registry.queries().keys() == oracles.oracle_sql().keys()
    assert registry.queries().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", registry.queries())
def test_query(spark, duck, name):
    got = _canonical(registry.queries()[name](spark, SF_DIR).toPandas())
    want = _canonical(duck.execute(oracles.oracle_sql()[name]).df())
    assert list(got.columns) == list(want.columns)
    assert len(got) == len(want) > 0
    assert got.equals(want)


def test_entry(spark):
    assert contract.entry(spark).count() > 0


def test_archive_scan_has_a_batch_a_delivery(spark, tmp_path, monkeypatch):
    """However many files a delivery has; the rows are all there, archived or not."""
    rows = [(k, f"2021-08-02 12:{k // 60 % 60:02}:{k % 60:02}", k % 5, ("click", "view", "error")[k % 3], k / 7) for k in range(600)]
    events = spark.createDataFrame(rows, "event_id long, ts string, user_id long, event_type string, value double")
    events.selectExpr("event_id", "cast(ts as timestamp_ntz) ts", "user_id", "event_type", "value").write.parquet(
        f"{tmp_path}/events.parquet"
    )
    feed = registry._l3(spark, str(tmp_path)).repartition(6)
    monkeypatch.setattr(registry, "_l3", lambda *_: feed)
    monkeypatch.setattr(registry, "fresh_path", lambda _, name: f"{tmp_path}/{name}")
    got = registry.queries()["stream_archive_scan"](spark, str(tmp_path))
    assert sorted(r["seq_num"] for r in got.select("seq_num").collect()) == list(range(600))
    assert len({f for f in got.inputFiles()}) > 3
    assert len([c for c in (tmp_path / "archiving/progress/commits").iterdir() if c.name.isdigit()]) == 3

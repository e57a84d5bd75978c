"""Every registered query of the engine against its SQL in DuckDB."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from brickwork.plans import catalogue

SF = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.sql(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_against_sql(spark, db, name):
    df = catalogue.QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    wanted = db.sql(catalogue.ORACLES[name])
    names = [d[0] for d in wanted.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    assert got == sorted(repr(tuple(x[i] for i in at)) for x in wanted.fetchall())


def test_signals_compose_titles(spark, monkeypatch):
    latest = catalogue.lv.latest
    monkeypatch.setattr(catalogue.lv, "latest", lambda s, d: latest(s, d).limit(1).selectExpr("* EXCEPT (title)", "'Ｂ１２ ｇａｒｄｅｎ' AS title"))
    row = catalogue.title_signals(spark, str(SF)).first()
    assert (row["building"], row["has_garden"]) == ("B12", True)


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0

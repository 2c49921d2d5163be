"""Every registered query against its DuckDB SQL."""

from __future__ import annotations

import duckdb
import pytest

from corpusmill.plans import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _rows(rows, columns) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    text = lambda v: f"{v:.9g}" if isinstance(v, float) else str(v)
    return sorted(tuple(text(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, name: str) -> None:
    out = QUERIES[name](spark, sf)
    got = _rows([tuple(r) for r in out.collect()], out.columns)
    assert got
    if name in ORACLES:
        db = duckdb.connect()
        for t in TABLES:
            db.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
        want = db.sql(ORACLES[name])
        assert sorted(out.columns) == sorted(want.columns)
        assert got == _rows(want.fetchall(), want.columns)

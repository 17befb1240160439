"""The text queries that SQL can express, against their twins in DuckDB."""

import duckdb
import pytest

pytest.importorskip("pricewatch.llm")

from conftest import SF_SMALL  # noqa: E402
from pricewatch.llm.queries import ORACLE, QUERIES  # noqa: E402


def _rows(names, found):
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    return cols, sorted((tuple(round(r[i], 6) if isinstance(r[i], float) else r[i] for i in at) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df, found = QUERIES[name](spark, SF_SMALL), con.execute(ORACLE[name])
    got, want = _rows(df.columns, df.collect()), _rows([d[0] for d in found.description], found.fetchall())
    assert got == want

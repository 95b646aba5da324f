"""The rows of the report tables in their order, against the SQL with its ORDER BY."""
import duckdb
import pytest

import __spark_entry__ as E
from tests.conftest import SF_CHECK
from vigia.operators import report as R

ORDER = {"by_country": '"Cantidad" DESC, "País"', "by_day": "fecha", "countries": "pais", "detail": "strptime(fecha, '%d-%m-%Y') DESC, url"}


@pytest.mark.parametrize("key", sorted(ORDER))
def test_rows_come_in_order(spark, key):
    con = duckdb.connect()
    for t in ("documents", "events", "orders", "customer", "nation", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_CHECK}/{t}.parquet'")
    df = E.queries()[key](spark, SF_CHECK)
    want = con.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in df.columns)} FROM ({E.oracle_sql()[key]}) x ORDER BY {ORDER[key]}").fetchall()
    got = [tuple(r) for r in df.collect()]
    assert got == want and len(got) > 3


def test_ties_and_nulls(spark):
    rows = [("02-01-2024", "B", "b"), ("01-01-2024", "A", "z"), ("02-01-2024", None, "a"), ("x", "A", "q"), ("01-01-2024", "B", "y")]
    h = R.prepare(spark.createDataFrame(rows, "fecha string, pais string, url string").selectExpr("*", "'i' AS institucion", "'t' AS titulo"))
    assert [r.url for r in R.detail(h).collect()] == ["a", "b", "y", "z", "q"]  # no date comes last
    assert [tuple(r) for r in R.by_country(h).collect()] == [("A", 2), ("B", 2)]
    assert [r.pais for r in R.countries(h).collect()] == ["A", "B"]
    assert [r.Alertas for r in R.by_day(h).collect()] == [1, 2, 2]

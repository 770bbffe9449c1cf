import pytest
from pyspark.sql import functions as F

from marginlens.sources.ingest import ingest, read_source, read_untyped
from marginlens.sources.schemas import KEY_COLUMNS, SOURCE_COLUMNS, SOURCE_SCHEMA
from tests.conftest import route_day


def _csv(path, header, rows):
    with open(path, "w") as f:
        f.write(",".join(header) + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def _row(**kw):
    r = route_day(**kw)
    return [r[c] for c in SOURCE_COLUMNS]


def test_schema_is_fixed():
    assert len(SOURCE_SCHEMA.fields) == 39
    assert len(KEY_COLUMNS) == 12
    assert SOURCE_COLUMNS[0] == "route_date_key" and SOURCE_COLUMNS[-1] == "incident_type"


def test_typed_read_with_lineage(spark, tmp_path):
    p = str(tmp_path / "ok.csv")
    _csv(p, SOURCE_COLUMNS, [_row(), _row(route_date_key="K-2")])
    df = ingest(spark, p)
    assert len(df.columns) == 42
    rows = df.collect()
    assert len(rows) == 2
    assert rows[0]["total_stops"] == 80 and rows[0]["total_revenue"] == 2400.0
    assert df.filter(F.col("_source_file").isNull() | F.col("_ingested_at").isNull()).count() == 0
    assert read_untyped(spark, p).count() == 2


def test_bad_value_fails_fast(spark, tmp_path):
    p = str(tmp_path / "bad.csv")
    _csv(p, SOURCE_COLUMNS, [_row(num_drivers="NOT_AN_INT")])
    with pytest.raises(Exception):
        read_source(spark, p).collect()


def test_permuted_header_is_rejected(spark, tmp_path):
    cols = list(SOURCE_COLUMNS)
    i, j = cols.index("labour_cost"), cols.index("fuel_cost")
    cols[i], cols[j] = cols[j], cols[i]
    p = str(tmp_path / "perm.csv")
    r = route_day()
    _csv(p, cols, [[r[c] for c in cols]])
    with pytest.raises(Exception):
        read_source(spark, p).collect()

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(Path(__file__).resolve().parent)]

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tidewatch.session import local_session

    session = local_session(8, "tests")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def con():
    from compare import oracle

    return oracle(SMALL)


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema to a DataFrame; text in date columns is parsed."""

    def make(rows, schema: str):
        from pyspark.sql import functions as F

        dates = [part.split()[0] for part in schema.split(",") if part.split()[1] == "date"]
        text = ", ".join(f"{p.split()[0]} {'string' if p.split()[1] == 'date' else p.split()[1]}" for p in schema.split(","))
        df = spark.createDataFrame(rows, text)
        return df.withColumns({d: F.to_date(d) for d in dates}) if dates else df

    return make


def values(df, column: str, *order: str) -> list:
    return [r[column] for r in df.orderBy(*order).collect()]

import os
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
os.environ.setdefault("PYTHONPATH", "")
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parent.parent}:{os.environ['PYTHONPATH']}"

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    connection = duckdb.connect()
    for path in Path(DATA).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return connection


@pytest.fixture(scope="session")
def same_rows(spark, duck):
    """Whether a query gives the rows of its SQL."""

    def compare(query, sql):
        df = query(spark, DATA)
        rows, names = [tuple(r) for r in df.collect()], df.columns
        found = duck.sql(sql)
        assert sorted(names) == sorted(found.columns)
        order = [found.columns.index(n) for n in names]
        text = lambda rows: sorted(tuple((v is None, str(v)) for v in r) for r in rows)
        assert text(rows) == text([tuple(r[i] for i in order) for r in found.fetchall()])

    return compare


@pytest.fixture(scope="module")
def value(spark):
    """The value of an expression over one string (or several)."""

    def of(make, *args):
        row = spark.createDataFrame([args], ", ".join(f"c{i} string" for i in range(len(args))))
        return row.select(make(*(F.col(f"c{i}") for i in range(len(args)))).alias("v")).first()[0]

    return of

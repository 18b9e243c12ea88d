import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.default.parallelism", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "3g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMALL = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def small():
    if not SMALL.exists():
        pytest.skip("no test tables here")
    return str(SMALL)


def plain(value):
    """A value as it compares across engines."""
    if hasattr(value, "tolist"):
        value = value.tolist()
    return repr(value)


@pytest.fixture(scope="session")
def same_as_sql(spark, small):
    """Runs a registered query and its SQL and compares their rows."""
    import duckdb

    con = duckdb.connect()
    for path in SMALL.glob("*.parquet"):
        con.execute(f"create view {path.stem} as select * from '{path}'")

    def compare(query, sql):
        df = query(spark, small)
        columns = sorted(df.columns)
        rows = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
        result = con.execute(sql)
        names = [d[0] for d in result.description]
        assert sorted(names) == columns
        expected = sorted(tuple(plain(r[names.index(c)]) for c in columns) for r in result.fetchall())
        assert rows == expected

    return compare

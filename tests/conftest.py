import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from activlake.session import get_session  # noqa: E402

SMALL = Path("/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = get_session(
        "tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
        log_level="ERROR",
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    if not SMALL.exists():
        pytest.skip("driver tables are not on this machine")
    return str(SMALL)


@pytest.fixture
def evaluate(spark):
    """Value of a column expression over one row of literals."""
    from pyspark.sql import functions as F

    def run(expression, schema="x string", **values):
        row = spark.createDataFrame([tuple(values.values()) or (None,)], schema)
        return row.select(expression.alias("out")).first()["out"]

    return run


def rows(df, *columns):
    """Collected rows as sorted tuples, nulls first."""
    data = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(data, key=lambda r: [(v is not None, str(v)) for v in r])


def plan_of(df):
    """Text of the physical plan."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tallyloom.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    settings = {
        "spark_ui_enabled": "false",
        "spark_sql_shuffle_partitions": "4",
        "spark_ui_showConsoleProgress": "false",
        "spark_checkpoint_dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tests", "local[4]", **settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """DataFrame from rows and a schema string."""
    from tallyloom.sources.tables import rows_table

    return lambda rows, schema: rows_table(spark, rows, schema)


def values(df):
    return sorted([tuple(row) for row in df.collect()], key=repr)


@pytest.fixture(scope="session")
def rows():
    return values

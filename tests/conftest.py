import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from larder.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark_sql_shuffle_partitions="4",
        spark_ui_enabled="false",
        **{"spark_checkpoint_dir": str(tmp_path_factory.mktemp("shared"))},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows_of(df, *columns):
    """Rows as a sorted list of tuples."""
    out = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in out.collect()), key=lambda t: tuple((v is not None, str(v)) for v in t))


@pytest.fixture
def rows():
    return rows_of

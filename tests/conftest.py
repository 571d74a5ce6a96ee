import os

import pytest

from sitebooks.runtime import build_session

SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]",
        "tests",
        spark_ui_enabled="false",
        spark_sql_shuffle_partitions="4",
        spark_driver_memory="4g",
        spark_sql_warehouse_dir=str(tmp_path_factory.mktemp("warehouse")),
        spark_checkpoint_dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SMALL


def rows(df, *columns):
    """Rows as sorted tuples; nulls sort first."""
    picked = df.select(*columns) if columns else df
    key = lambda t: tuple((v is not None, str(type(v)), v if v is not None else 0) for v in t)
    return sorted((tuple(r) for r in picked.collect()), key=key)

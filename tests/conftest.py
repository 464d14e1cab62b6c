import sys
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session options for one test: ``with conf(name=value)``; dots written as ``__``."""

    @contextmanager
    def setting(**options):
        names = {k.replace("__", "."): str(v) for k, v in options.items()}
        before = {k: spark.conf.get(k, None) for k in names}
        for k, v in names.items():
            spark.conf.set(k, v)
        try:
            yield
        finally:
            for k, v in before.items():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)

    return setting


def rows(df, *columns):
    """Sorted tuples of the named columns."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)

import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from reelhouse.session import local_session

    session = local_session("8", shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return FOLDER


@pytest.fixture
def one(spark):
    """Values of column expressions over one row."""
    from pyspark.sql import functions as F

    def values(build, *inputs):
        row = spark.range(1).select(*[F.lit(v).alias(f"c{i}") for i, v in enumerate(inputs)])
        return row.select(build(*[F.col(f"c{i}") for i in range(len(inputs))]).alias("out")).first()["out"]

    return values

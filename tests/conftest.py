import pytest

from tradebinder.session import local_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, 4)
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoint")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column expression on a single row."""

    def run(column, **values):
        frame = spark.range(1)
        for name, value in values.items():
            from pyspark.sql import functions as F

            frame = frame.withColumn(name, F.lit(value))
        return frame.select(column.alias("x")).first().x

    return run

import pytest

from emberline.session import build_session


@pytest.fixture(scope="session")
def spark():
    settings = {"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.sql.adaptive.coalescePartitions.enabled": "true"}
    session = build_session("tests", "local[8]", settings)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def edges(spark):
    def make(pairs):
        return spark.createDataFrame(list(pairs), "src bigint, dst bigint")

    return make

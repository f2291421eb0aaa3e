import pytest

from kindred.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("2", "4g", "tests")
    session.conf.set("spark.sql.shuffle.partitions", "2")
    yield session


@pytest.fixture(scope="session")
def entities(spark):
    def make(rows):
        return spark.createDataFrame(rows, "entity_id string, business_name string, business_address string")

    return make

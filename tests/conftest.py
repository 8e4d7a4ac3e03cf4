import pytest

from trackframe.session import builder


@pytest.fixture(scope="session")
def spark():
    session = (
        builder("tests").master("local[8]").config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g").config("spark.ui.enabled", "false").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()

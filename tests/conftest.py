import pytest

from tidewater import session


@pytest.fixture(scope="session")
def spark():
    spark = session.local(4, partitions=4, app="tests")
    spark.sparkContext.setLogLevel("ERROR")
    # tables of a few rows: compiling a plan would take longer than running it
    spark.conf.set("spark.sql.codegen.wholeStage", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield spark
    spark.stop()

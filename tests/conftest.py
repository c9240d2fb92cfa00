import pytest

from paperlane.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "paperlane-tests", "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Value of a column expression of one text."""
    from pyspark.sql import functions as F

    def evaluate(expression, text):
        frame = spark.createDataFrame([(text,)], "text string")
        return frame.select(expression(F.col("text")).alias("out")).first()["out"]

    return evaluate

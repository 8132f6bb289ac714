import pytest


@pytest.fixture(scope="session", autouse=True)
def checkpoints(spark, tmp_path_factory):
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


@pytest.fixture(scope="session")
def docs(spark):
    """Builds documents with a clashing extra column from (doc_id, text) pairs."""

    def build(rows, extra="chunk"):
        return spark.createDataFrame([(i, t, "x") for i, t in rows], f"doc_id bigint, text string, {extra} string")

    return build

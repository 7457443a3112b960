import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from gaceta.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, app="gaceta-tests", partitions=4)
    # Tests own their shared folder; a cluster names one in spark.checkpoint.dir.
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def evaluate(spark):
    """Values of a column expression over literal inputs."""
    def run(inputs, expression):
        rows = [(i, value) for i, value in enumerate(inputs)]
        df = spark.createDataFrame(rows, "i int, x string")
        return [r["y"] for r in df.select("i", expression("x").alias("y")).orderBy("i").collect()]

    return run

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.python.unix.domain.socket.enabled", "true")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """Collected rows as a sorted list of tuples."""

    def collect(df, *columns):
        found = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in found.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect


class FileFeed:
    """A stream over a folder to which tests add one file per micro-batch."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, folder, schema
        folder.mkdir()

    def add(self, data):
        frame = self.spark.createDataFrame(data, self.schema).coalesce(1)
        frame.write.mode("append").json(str(self.folder))

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).json(str(self.folder))


@pytest.fixture
def feed(spark, tmp_path):
    counter = iter(range(1000))
    return lambda schema: FileFeed(spark, tmp_path / f"feed{next(counter)}", schema)

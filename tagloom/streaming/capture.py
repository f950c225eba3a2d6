"""Captured annotations as a stream: validated, upserted by type and second, counted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import safe_timestamp

PAYLOAD = "html string, label string, url string, timestamp string"
STORED = "name string, batch long, timestamp string, type string, example_html string, expected_json string"


def payloads(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of captures (one JSON object in each line of the files that arrive); the label's text is kept."""
    lines = spark.readStream.schema("value string").text(folder)
    return from_lines(lines)


def from_lines(lines: DataFrame) -> DataFrame:
    j = lambda k: F.get_json_object("value", f"$.{k}").alias(k)
    return lines.select(j("html"), j("label"), j("url"), j("timestamp"))


def annotations(captures: DataFrame) -> DataFrame:
    """name, type, example_html, expected_json, timestamp of the captures that may be saved; the name holds the type and the second."""
    label = F.try_parse_json("label")
    kind = F.try_variant_get(label, "$.type", "string")
    good = captures.filter(kind.isNotNull() & (F.coalesce(F.trim("html"), F.lit("")) != ""))
    return good.select(F.concat(F.lit("annotation_"), kind, F.lit("_"), safe_timestamp(F.col("timestamp")), F.lit(".json")).alias("name"), kind.alias("type"), F.col("html").alias("example_html"), F.col("label").alias("expected_json"), "timestamp")


def latest(rows: DataFrame) -> DataFrame:
    """The last row of each name (by batch, then time): a save of the same type and second replaces the one before."""
    by_name = rows.groupBy("name").agg(F.max(F.struct("batch", "timestamp", "type", "example_html", "expected_json")).alias("x"))
    return by_name.select("name", "x.*")


class Store:
    """The last save of each name, kept in a folder by batches that are merged as they grow.

    ``new/batch=N`` holds the last row of each name in a batch, ``base/upto=N`` the last row of each name of all batches up
    to N. When the batches after a base hold more than ``share`` of its bytes, base and batches are merged into the next
    base: so reading costs the live rows and a bounded part more, and over time each row is written a bounded number
    of times. A base counts once it is complete; the one before stays until the next, for readers that began with it.
    """

    def __init__(self, spark: SparkSession, folder: str, share: float = 0.25):
        self.spark, self.folder, self.share = spark, folder.rstrip("/"), share
        place = spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        self.files = place.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")

    def _numbers(self, kind: str, key: str) -> list[int]:
        """The complete folders of a kind, by number."""
        if not self.files.exists(self._path(kind)):
            return []
        found = [s.getPath().getName() for s in self.files.listStatus(self._path(kind))]
        numbers = [int(n.removeprefix(f"{key}=")) for n in found if n.startswith(f"{key}=")]
        return sorted(n for n in numbers if self.files.exists(self._path(f"{kind}/{key}={n}/_SUCCESS")))

    def _size(self, names: list[str]) -> int:
        return sum(self.files.getContentSummary(self._path(n)).getLength() for n in names)

    def parts(self) -> tuple[int, list[str]]:
        """The batch up to which the base goes (-1: no base), and the folders that hold the store: base and later batches."""
        upto = max(self._numbers("base", "upto"), default=-1)
        return upto, [f"base/upto={upto}"] * (upto >= 0) + [f"new/batch={n}" for n in self._numbers("new", "batch") if n > upto]

    def add(self, rows: DataFrame, number: int) -> None:
        """A batch of annotations. Adding it again changes nothing."""
        if number <= self.parts()[0]:
            return
        latest(rows.withColumn("batch", F.lit(number).cast("long"))).write.mode("overwrite").parquet(f"{self.folder}/new/batch={number}")
        upto, names = self.parts()
        if self._size([n for n in names if n.startswith("new/")]) > self.share * self._size([n for n in names if n.startswith("base/")]):
            self.merge()

    def merge(self) -> None:
        """Base and later batches become the next base; what is older than the base before goes."""
        upto, names = self.parts()
        last = max(self._numbers("new", "batch"), default=-1)
        if last > upto:
            latest(self._read(names)).write.mode("overwrite").parquet(f"{self.folder}/base/upto={last}")
            for n in self._numbers("base", "upto"):
                if n < upto:
                    self.files.delete(self._path(f"base/upto={n}"), True)
            for n in self._numbers("new", "batch"):
                if n <= upto:
                    self.files.delete(self._path(f"new/batch={n}"), True)

    def _read(self, names: list[str]) -> DataFrame:
        rows = self.spark.read.schema(STORED)
        return rows.parquet(*[f"{self.folder}/{n}" for n in names]) if names else self.spark.createDataFrame([], STORED)

    def rows(self) -> DataFrame:
        """name, timestamp, type, example_html, expected_json of the last save of each name."""
        return latest(self._read(self.parts()[1])).drop("batch")


def save(captures: DataFrame, folder: str, checkpoint: str):
    """Upserts each batch of captures into the ``Store`` in a folder; ``saved`` reads it. Running a batch again changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        Store(batch.sparkSession, folder).add(annotations(batch), number)

    return captures.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def saved(spark: SparkSession, folder: str) -> DataFrame:
    return Store(spark, folder).rows()


def running_counts(captures: DataFrame) -> DataFrame:
    """Saves by type so far; for output mode complete."""
    return annotations(captures).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def once(rows: DataFrame, key: str, time: str, delay: str = "10 minutes") -> DataFrame:
    """Each key once within the watermark: state for keys that are older goes."""
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def stream_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """A Parquet table as a stream of its files."""
    folder, _, name = path.rpartition("/")
    return spark.readStream.schema(schema).option("pathGlobFilter", name).parquet(folder)


def drained(counts: DataFrame, name: str) -> DataFrame:
    """What a grouped stream holds when all that is there has been read. For results with a bounded number of groups."""
    spark = counts.sparkSession
    q = counts.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name)

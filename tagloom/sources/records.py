"""Sources: annotation files, JSON lines, URL lists and domain lists."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import scratch

KEYS = ("example_html", "expected_json")


#: Names of annotation files.
ANNOTATIONS = "annotation_*.json"


def annotation_files(spark: SparkSession, folder: str, names: str = ANNOTATIONS) -> DataFrame:
    """file, raw of every annotation file; one object in each file, in order of names when sorted by file. Spark packs small files into tasks by size."""
    return spark.read.text(f"{folder}/{names}", wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("raw"))


#: Files of one batch of a scan: the driver plans a batch as a whole and holds some 14 kB for each file.
SCAN_FILES = 4_000

#: While a scan runs: a batch's files are looked up in few tasks (else one for each file) and read many in a task (else few, as
#: each counts for 4 MB), for the driver keeps a record of every task; what it knows of a file isn't kept for later reads, as there are none.
SCAN_SETTINGS = {
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
    "spark.sql.files.openCostInBytes": "256k",
    "spark.sql.hive.filesourcePartitionFileCacheSize": "0",
}


def scan_new(spark: SparkSession, folder: str, state: str, names: str = ANNOTATIONS, parts: Iterable[str] | None = None) -> DataFrame:
    """file, type, reason, part, batch of all annotation files so far; only files that no scan with this ``state`` has read are read.

    The files are a stream that ends with what is there, SCAN_FILES at a time. Its log tells which have been read; what was
    found in them is appended below ``state``, a folder for each batch, so a batch that runs again replaces its own rows.
    The driver knows the names of all files of a stream. Where there are too many for that, ``parts`` names the folders below
    ``folder`` that hold them: each is a stream of its own, with its own log and batches, one after another.
    """
    if parts is None:
        _scan_folder(spark, folder, f"{state}/log", f"{state}/found", names)
    else:
        for part in parts:
            own = "part=" + quote(part, safe="")  # Spark reads the name back
            _scan_folder(spark, f"{folder}/{part}", f"{state}/log/{own}", f"{state}/found/{own}", names)
    return spark.read.schema("file string, type string, reason string, part string, batch long").parquet(f"{state}/found")


def _scan_folder(spark: SparkSession, folder: str, log: str, place: str, names: str) -> None:
    def keep(batch: DataFrame, number: int) -> None:
        # without this each task that reads files would leave one of its own
        batch.repartition(1).write.mode("overwrite").parquet(f"{place}/batch={number}")

    before = {k: spark.conf.get(k) for k in SCAN_SETTINGS}
    try:  # Spark reads these as the stream runs
        for k, v in SCAN_SETTINGS.items():
            spark.conf.set(k, v)
        files = spark.readStream.schema("value string").option("pathGlobFilter", names).option("maxFilesPerTrigger", SCAN_FILES).text(folder, wholetext=True)
        found = validated(files.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("raw"))).select("file", "type", "reason")
        found.writeStream.foreachBatch(keep).option("checkpointLocation", log).trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def has_key(json: Column, path: str) -> Column:
    """Whether a key is there, be it null."""
    return F.try_variant_get(json, path, "variant").isNotNull()


def validated(rows: DataFrame) -> DataFrame:
    """rows(raw, ...) with example_html, expected_json (text as written), type and reason (null if valid).

    A row is either valid or has a reason, never both. A key with null counts
    as there; the label must be an object and its type, if any, a string.
    """
    v = F.try_parse_json("raw")
    label = F.try_variant_get(v, "$.expected_json", "variant")
    reason = (
        F.when(v.isNull(), "not JSON")
        .when(~F.schema_of_variant(v).startswith("OBJECT"), "not an object")
        .when(~has_key(v, "$.example_html"), "no example_html")
        .when(~has_key(v, "$.expected_json"), "no expected_json")
        .when(~F.schema_of_variant(label).startswith("OBJECT"), "expected_json is not an object")
        .when(~has_key(v, "$.expected_json.type"), "no type")
    )
    return rows.withColumns({
        "example_html": F.try_variant_get(v, "$.example_html", "string"),
        "expected_json": F.get_json_object("raw", "$.expected_json"),
        "type": F.try_variant_get(v, "$.expected_json.type", "string"),
        "reason": reason,
    })


def valid(rows: DataFrame) -> DataFrame:
    return validated(rows).filter("reason is null").drop("reason")


def rejects(rows: DataFrame) -> DataFrame:
    return validated(rows).filter("reason is not null").select("file", "reason")


def type_counts(rows: DataFrame) -> DataFrame:
    """type, n of the rows(raw) that are valid; what can't be read doesn't count."""
    return valid(rows).groupBy("type").agg(F.count(F.lit(1)).alias("n"))


def typed_by_name(rows: DataFrame) -> DataFrame:
    """rows(file, raw) with the type that the file name tells, others dropped, and whether the label disagrees."""
    named = F.when(F.col("file").contains("recipe"), "recipe").when(F.col("file").contains("job_posting"), "job_posting").when(F.col("file").contains("event"), "event")
    own = F.try_variant_get(F.try_parse_json("raw"), "$.expected_json.type", "string")
    return rows.withColumns({"type_by_name": named, "disagrees": ~own.eqNullSafe(named)}).filter("type_by_name is not null")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, line (from 1 in its file), place (from 0 over all files, in order of their names), raw of text files.

    No sort: the lines of each part of a file that a task reads are counted first, in a pass of its own; a line's number is its
    place in its part and the sum of the counts before, one number for each part.
    """
    rows = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("mark"), F.col("value").alias("raw"))
    parts = rows.groupBy("file", "block").agg(F.min("mark").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)  # of parts, not of lines
    in_file = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = parts.select(F.col("file").alias("of_file"), F.col("block").alias("of_block"), "first", *[F.coalesce(F.sum("n").over(w), F.lit(0)).alias(name) for name, w in (("place_start", before), ("line_start", in_file))])
    known = scratch.kept(starts, "lines")  # its size is known when the join is planned
    at = F.col("mark") - F.col("first")
    joined = rows.join(known, (F.col("file") == F.col("of_file")) & (F.col("block") == F.col("of_block")))
    return joined.select("file", (F.col("line_start") + at + 1).alias("line"), (F.col("place_start") + at).alias("place"), "raw")


def json_lines(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """raw of JSON lines files, and with ``strict`` file and line before it (as ``lines`` gives them): there a blank or malformed line is an error, which names its line, when it is read."""
    if not strict:
        return spark.read.text(path).select(F.col("value").alias("raw"))
    where = F.concat(F.lit("line "), F.col("line").cast("string"), F.lit(" of "), F.col("file"), F.lit(": not a line of JSON: "), F.left("raw", F.lit(80)))
    return lines(spark, path).select("file", "line", F.when(F.try_parse_json("raw").isNull(), F.raise_error(where)).otherwise(F.col("raw")).alias("raw"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """url, host of a text file with a URL in each line."""
    url = F.trim("value")
    return spark.read.text(path).select(url.alias("url")).filter("url <> ''").withColumn("host", F.parse_url("url", F.lit("HOST")))


def domains(lines: DataFrame) -> DataFrame:
    """url, place of the distinct domains in the bullets of a Markdown list(line, place), in order of first mention.

    A bullet's domain is its first bold text or else its first word, up to a
    slash; it must hold a dot. Blank lines, headings and notes don't count.
    """
    line = F.trim("line")
    bold = F.split(line, r"\*\*")
    rest = F.trim(F.substring(line, 2, 1 << 20))
    name = F.when(F.size(bold) >= 3, F.trim(F.get(bold, F.lit(1)))).otherwise(F.get(F.split(rest, r"\s+"), F.lit(0)))
    name = F.trim(F.get(F.split(name, "/"), F.lit(0)))
    found = lines.filter(line.startswith("-")).select(name.alias("domain"), "place").filter(F.col("domain").contains("."))
    return found.groupBy(F.concat(F.lit("https://"), "domain").alias("url")).agg(F.min("place").alias("place"))


def domain_list(spark: SparkSession, path: str) -> DataFrame:
    """``domains`` of Markdown files, in order of their names."""
    return domains(lines(spark, path).select("place", F.col("raw").alias("line")))


def published(spark: SparkSession, path: str, split: str, limit: int | None = None, order: str | None = None) -> DataFrame:
    """The rows of one split of a published table (folders ``split=...``); others aren't read. With ``limit``, the first rows in ``order``."""
    rows = spark.read.parquet(path).filter(F.col("split") == split)
    if limit is None:
        return rows
    if order is None:
        raise ValueError("a limit needs an order that tells rows apart")
    return rows.orderBy(order).limit(limit)

"""Materialised views and metric records."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pairloom.session import TEXT_FILES, cut_lineage, settings, shuffles_freed

SPACE = re.compile(r"\s*")
BEGIN = re.compile(r"\n(?=[{\[])")


def write_view(view: DataFrame, path: str) -> None:
    """Parquet, one folder per split; texts are most of it, so files are as TEXT_FILES says.

    Files of both splits are open at once, so that rows need no sort by their split and stay in order.
    """
    spark = view.sparkSession
    with settings(spark, spark_sql_maxConcurrentOutputFileWriters="2"), shuffles_freed(spark):
        view.write.mode("overwrite").options(**TEXT_FILES).partitionBy("split").parquet(path)


def write_counted(view: DataFrame, path: str, splits: tuple[str, ...] = ("train", "val")) -> dict[str, int]:
    """Write a view and return its rows per split, counted while they are written and not by another scan."""
    seen = Observation()
    counts = [F.count_if(F.col("split") == name).alias(name) for name in splits]
    write_view(view.observe(seen, *counts), path)
    return {name: seen.get.get(name, 0) for name in splits}


def read_view(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    view = spark.read.parquet(path)
    return view if split is None else view.where(F.col("split") == split)


def write_metrics(record: DataFrame, path: str) -> None:
    """JSON records, one to a line; absent parts are left out."""
    record.write.mode("overwrite").json(path)


RECORD_SCHEMA = "path string, place int, record string, corrupt string"


def split_records(text: str) -> Iterator[tuple[str | None, str | None]]:
    """The top-level JSON values of a text, whatever stands on a line, as (record, None) or (None, what is corrupt).

    Depth and string state decide where a value ends, so records may be indented, follow one another without
    a line break, or stand one to a line. What cannot be read up to the next line that begins a value
    is one corrupt piece; reading goes on there.
    """
    decoder = json.JSONDecoder()
    at = 0
    while (start := SPACE.match(text, at).end()) < len(text):
        try:
            _, at = decoder.raw_decode(text, start)
            yield text[start:at], None
        except (ValueError, RecursionError):
            following = BEGIN.search(text, start + 1)
            at = following.start() + 1 if following else len(text)
            yield None, text[start:at].strip()


def metric_records(spark: SparkSession, path: str, pattern: str = "*.json") -> DataFrame:
    """Every JSON value of every file below a folder: path, place in the file, and the record or what is corrupt.

    Metric files are small: each is read whole, by one task among many. An empty file has no row.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text in zip(batch.column("path").to_pylist(), batch.column("value").to_pylist(), strict=True):
                rows += [(name, i, *found) for i, found in enumerate(split_records(text.removeprefix("\ufeff")))]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[c.split()[0] for c in RECORD_SCHEMA.split(", ")],
            )

    files = (
        spark.read.option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .text(path, wholetext=True)
        .select(F.col("_metadata.file_path").alias("path"), "value")
    )
    return files.mapInArrow(split, RECORD_SCHEMA)


def record_schema(records: DataFrame) -> str:
    """Schema that holds all records, merged by an aggregate; fractions are doubles, what is always null a string."""
    merged = records.agg(F.schema_of_variant_agg(F.try_parse_json("record")).alias("s")).first()["s"]
    merged = re.sub(r"\bOBJECT<", "STRUCT<", merged or "")
    merged = re.sub(r"\bDECIMAL\(\d+,\s*\d+\)|\bFLOAT\b", "DOUBLE", merged)
    merged = re.sub(r"\b(VOID|VARIANT)\b", "STRING", merged)
    return merged if merged.startswith("STRUCT<") else "STRUCT<>"


def read_metrics(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Every JSON record below a folder with its path, sorted by path and place in the file.

    Without a schema it is inferred from all records. Pieces that are no record come as rows with `_corrupt_record`,
    a column that is there only if there are such pieces; so do values that are no objects.
    """
    found = cut_lineage(metric_records(spark, path))
    objects = F.col("record").startswith("{")
    found = found.select(
        "path",
        "place",
        F.when(objects, F.col("record")).alias("record"),
        F.when(~objects, F.col("record")).otherwise(F.col("corrupt")).alias("_corrupt_record"),
    )
    schema = schema or record_schema(found.where("record IS NOT NULL"))
    ordered = found.withColumn("r", F.from_json("record", schema)).orderBy("path", "place")
    extra = [] if found.where("_corrupt_record IS NOT NULL").isEmpty() else ["_corrupt_record"]
    return ordered.select("path", "r.*", *extra)

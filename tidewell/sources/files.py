"""Readers for landed files, all with explicit schemas, and the dated landing sink."""

from __future__ import annotations

import csv
import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from tidewell.functions.text import null_tokens
from tidewell.schemas import GBD_MEASURES, GHO_CATALOGUE, ICD_MAP

# Functions of this module travel to the workers with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def envelope_schema(lists: dict[str, StructType]) -> StructType:
    """One landed document: run fields and the named record lists under ``data``."""
    data = StructType([StructField(n, ArrayType(s)) for n, s in lists.items()])
    return StructType([
        StructField("fetched_at", StringType()), StructField("source_api", StringType()),
        StructField("data", data),
    ])


def explode_envelope(documents: DataFrame, list_field: str) -> DataFrame:
    """One row per record of ``data.<list_field>``, with its document's run fields."""
    return documents.select(
        "source_api", "fetched_at", F.explode(f"data.{list_field}").alias("_record")
    ).select("source_api", "fetched_at", "_record.*")


def read_envelope(spark: SparkSession, path: str | list[str], list_field: str,
                  record: StructType, multi_line: bool = True) -> DataFrame:
    """Records of landed JSON documents.

    Landed documents span lines (``multi_line``), so one file is one task;
    NDJSON files of documents are split.
    """
    documents = (
        spark.read.schema(envelope_schema({list_field: record}))
        .option("multiLine", multi_line).json(path)
    )
    return explode_envelope(documents, list_field)


def read_gho_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """The indicator and place catalogue document, with ``geo_catalogue`` as a map."""
    schema = StructType([StructField("data", GHO_CATALOGUE)])
    return spark.read.schema(schema).option("multiLine", True).json(path).select("data.*")


def read_ndjson_tolerant(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """NDJSON rows, without broken lines and without lines that hold none of the fields."""
    full = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    rows = spark.read.schema(full).option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    some = F.lit(False)
    for field in schema.fields:
        some = some | F.col(field.name).isNotNull()
    return rows.filter(F.col("_corrupt_record").isNull() & some).drop("_corrupt_record")


def read_ctis_csv(spark: SparkSession, path: str) -> DataFrame:
    """EU register export: quoted CSV, headers trimmed, "no value" texts as null.

    Every column is text. Quoted fields may hold line breaks.
    """
    raw = (
        spark.read.option("header", True).option("multiLine", True).option("quote", '"')
        .option("escape", '"').option("encoding", "UTF-8").csv(path)
    )
    return null_tokens(raw.toDF(*[c.lstrip("\ufeff").strip() for c in raw.columns]))


def _first_of_each_file(batches):
    """The first row of each run of rows that name the same file."""
    last = None
    for batch in batches:
        if batch.num_rows:
            files = batch.column(0)
            new = [0] if files[0].as_py() != last else []
            changed = pc.not_equal(files.slice(1), files.slice(0, len(files) - 1)).to_numpy(zero_copy_only=False)
            new += (np.flatnonzero(changed) + 1).tolist()
            last = files[-1].as_py()
            if new:
                yield batch.take(pa.array(new))


def first_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, header): the first line of each file that has one.

    A task reads the files it has one after the other, each in order, so the
    row where the file changes is the first line: nothing is sorted or kept.
    """
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("header"),
                                         F.col("_metadata.file_block_start").alias("start"))
    return lines.where("start = 0").select("file", "header").mapInArrow(_first_of_each_file, "file string, header string")


def files_by_header(spark: SparkSession, path: str | list[str]) -> dict[str, list[str]]:
    """First line -> the files that begin with it; one short row per file reaches the driver."""
    found: dict[str, list[str]] = {}
    for file, header in sorted(tuple(row) for row in first_lines(spark, path).collect()):
        found.setdefault(header.removeprefix("\ufeff").rstrip("\r"), []).append(file)
    return found


def read_by_header(spark: SparkSession, path: str | list[str], sep: str, kinds: Callable[[list[str]], StructType]) -> DataFrame:
    """Files whose columns stand in any order, bound by name; ``kinds`` gives the types of a header's columns.

    A column that a file lacks is null there. A file without lines adds nothing.
    """
    whole = None
    for header, group in files_by_header(spark, path).items():
        columns = next(csv.reader([header], delimiter=sep), [])
        part = spark.read.schema(kinds(columns)).option("sep", sep).option("header", True).option("enforceSchema", False).csv(group)
        whole = part if whole is None else whole.unionByName(part, allowMissingColumns=True)
    return spark.createDataFrame([], kinds([])) if whole is None else whole


def read_icd_map(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Tab-separated code map; codes and chapters stay text, columns found by header in each file."""
    header = read_by_header(spark, path, "\t", lambda names: StructType([StructField(n, StringType()) for n in names or ICD_MAP.names]))
    return header.select(*[F.col(f.name).cast(f.dataType) for f in ICD_MAP.fields])


def gbd_schema(columns: list[str]) -> StructType:
    """Types by column name: measures double, ids and year whole numbers, names text."""
    def kind(name: str):
        if name in GBD_MEASURES:
            return DoubleType()
        return LongType() if name.endswith("_id") or name == "year" else StringType()
    return StructType([StructField(c, kind(c)) for c in columns])


def read_gbd_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Disease-burden export; each file's columns are taken from its own header."""
    return read_by_header(spark, path, ",", gbd_schema)


def spread(df: DataFrame) -> DataFrame:
    """Deal out the rows of a scan that has fewer tasks than the session has cores.

    For per-row work on few, large row groups. Larger scans stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def land(df: DataFrame, folder: str, stem: str, day: Column, stamp: str) -> None:
    """Write NDJSON under ``folder/<stem>_<stamp>/dt=YYYY-MM-DD/``."""
    dated = df.withColumn("dt", F.date_format(day, "yyyy-MM-dd"))
    # Rebalanced by day: few files per day, and a large day is split over tasks.
    dated.hint("rebalance", "dt").write.mode("errorifexists").partitionBy("dt").json(f"{folder.rstrip('/')}/{stem}_{stamp}")

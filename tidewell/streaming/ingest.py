"""File streams: one route per landed file pattern, merged batch by batch.

The master is the state: late records only add their source, so no watermark
is needed, and a batch that is run again changes neither content nor version.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidewell.schemas import ARTICLE, GHO_RECORD, TRIAL_US, WHO_EMERGENCY, WHO_OUTBREAK, WORK
from tidewell.sources.files import envelope_schema
from tidewell.sources.master import Master


@dataclass(frozen=True)
class Route:
    """Which landed files go to which master."""

    pattern: str
    domain: str
    file_format: str = "json"
    lists: dict[str, StructType] = field(default_factory=dict)

    def schema(self) -> StructType:
        return envelope_schema(self.lists)


ROUTES: dict[str, Route] = {
    "news": Route("news_*.json", "articles", lists={"articles": ARTICLE}),
    "currents": Route("currentapi_*.json", "articles", lists={"articles": ARTICLE}),
    "who": Route("who_*.json", "articles",
                 lists={"emergencies": WHO_EMERGENCY, "disease_outbreak_news": WHO_OUTBREAK}),
    "ct_us": Route("clinical_trials_us_*.json", "trials", lists={"trials": TRIAL_US}),
    "ctis": Route("CTIS_*.csv", "trials", "csv"),
    "core": Route("core_*.json", "publications", lists={"works": WORK}),
    "gho": Route("gho_*.json", "health", lists={"records": GHO_RECORD}),
    "ihme": Route("IHME*.csv", "health", "csv"),
}


def open_files(spark: SparkSession, folder: str, route: Route, schema: StructType | None = None,
               max_files: int = 1000, multi_line: bool = True) -> DataFrame:
    """Stream of the files under ``folder`` that fit the route.

    CSV routes need their ``schema``; a file whose header differs from it fails.
    """
    reader = (
        spark.readStream.schema(schema or route.schema())
        .option("pathGlobFilter", route.pattern).option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", max_files).option("multiLine", multi_line)
    )
    if route.file_format == "csv":
        return reader.option("header", True).option("enforceSchema", False).option("escape", '"').csv(folder)
    return reader.json(folder)


def read_files(spark: SparkSession, folder: str, route: Route, schema: StructType | None = None,
               multi_line: bool = True) -> DataFrame:
    """The same files as a batch."""
    reader = (
        spark.read.schema(schema or route.schema()).option("pathGlobFilter", route.pattern)
        .option("recursiveFileLookup", True).option("multiLine", multi_line)
    )
    if route.file_format == "csv":
        return reader.option("header", True).option("enforceSchema", False).option("escape", '"').csv(folder)
    return reader.json(folder)


def merge_stream(rows: DataFrame, master: Master, checkpoint: str,
                 on_counts: Callable[[int, dict[str, int]], None] | None = None) -> StreamingQuery:
    """Upsert each micro-batch of normalised rows into ``master``.

    All sources of one master belong in one ``rows`` (a union of streams), so
    that the master has one writer.
    """
    def merge(batch: DataFrame, batch_id: int) -> None:
        counts = master.upsert(batch)
        if on_counts:
            on_counts(batch_id, counts)

    return (
        rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def ingest_stream(spark: SparkSession, folder: str, route: Route,
                  normalise: Callable[[DataFrame], DataFrame], master: Master, checkpoint: str,
                  schema: StructType | None = None, max_files: int = 1000,
                  multi_line: bool = True) -> StreamingQuery:
    """Stream one route into its master."""
    files = open_files(spark, folder, route, schema, max_files, multi_line)
    return merge_stream(normalise(files), master, checkpoint)


def backfill(spark: SparkSession, folder: str, day: str, route: Route,
             normalise: Callable[[DataFrame], DataFrame], master: Master,
             schema: StructType | None = None, multi_line: bool = True) -> dict[str, int]:
    """Process all files of one day again; equal dates leave content and version alone."""
    return master.upsert(normalise(read_files(spark, f"{folder.rstrip('/')}/{day}", route, schema, multi_line)))

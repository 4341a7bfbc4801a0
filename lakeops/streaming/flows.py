"""Streaming ingest, appends, complete aggregates and stream-static enrichment."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.sources.drift import UnknownFieldError, evolve_schema, rescue_json
from lakeops.sources.files import SchemaLike, as_struct, list_files
from lakeops.sources.ingest import load_schema, path_exists, save_schema
from lakeops.sources.mixed import Group, has_header, read_mixed, recorded, schema_groups


def _start(writer, trigger: str | None) -> StreamingQuery:
    """``trigger`` is an interval such as "4 seconds"; None drains what is there and stops."""
    if trigger is None:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    return writer.trigger(processingTime=trigger).start()


def read_stream(spark: SparkSession, src: str, fmt: str, schema: SchemaLike,
                **options: str) -> DataFrame:
    """Files of a folder as a stream; each path is read once per checkpoint."""
    return spark.readStream.format(fmt).schema(as_struct(schema)).options(**options).load(src)


def with_arrival(stream: DataFrame) -> DataFrame:
    """Add when a row arrived and which file it came from."""
    return stream.select("*", F.current_timestamp().alias("arrival_time"),
                         F.col("_metadata.file_path").alias("source_file"))


def append_stream(df: DataFrame, sink: str, checkpoint: str,
                  trigger: str | None = None) -> StreamingQuery:
    """Append a stream to a parquet table, exactly once per checkpoint."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint).option("path", sink))
    return _start(writer, trigger)


def complete_stream(agg: DataFrame, sink: str, checkpoint: str,
                    trigger: str | None = None) -> StreamingQuery:
    """Replace the table by the full aggregate after every micro-batch."""
    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(sink)

    writer = (agg.writeStream.outputMode("complete").foreachBatch(replace)
              .option("checkpointLocation", checkpoint))
    return _start(writer, trigger)


def daily_aggregate(stream: DataFrame, ts: str, keys: Sequence[str], aggs: Sequence[Column],
                    late: str = "1 day") -> DataFrame:
    """Daily totals whose state is dropped once a day is ``late`` behind (bounded state)."""
    day = F.window(ts, "1 day")
    return (stream.withWatermark(ts, late).groupBy(day, *keys).agg(*aggs)
            .withColumn("day", F.col("window.start").cast("date")).drop("window"))


def enrich_stream(stream: DataFrame, static: DataFrame, on: Sequence[str],
                  how: str = "inner") -> DataFrame:
    """Join every micro-batch with the static table as it is when the batch runs."""
    if how not in ("inner", "left"):
        raise ValueError("a stream can be joined inner or left to a static table")
    return stream.join(static, list(on), how)


SAMPLE_FILES = 1000      # files whose schemas start a feed; others are compared when they are loaded
FILES_PER_BATCH = "1000"  # unless the caller says otherwise: names that pass through the driver at a time
FILE_ROWS = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
# Options that choose files rather than tell how to read them.
CHOOSING = ("maxFilesPerTrigger", "maxBytesPerTrigger", "pathGlobFilter", "recursiveFileLookup", "maxFileAge",
            "latestFirst", "modifiedAfter", "modifiedBefore")


def _file_stream(spark: SparkSession, src: str, options: dict) -> DataFrame:
    """The names of new files as a stream; their contents are not read."""
    # Files may arrive with an older modification time than others that were read long ago.
    choice = {"maxFileAge": "36500d", "maxFilesPerTrigger": FILES_PER_BATCH,
              **{k: v for k, v in options.items() if k in CHOOSING}}
    return read_stream(spark, src, "binaryFile", FILE_ROWS, **choice).select("path")


def _rows_of(spark: SparkSession, groups: list[Group], fmt: str, schema: SchemaLike, rescue: bool,
             case_sensitive: bool, options: dict, prepare) -> DataFrame:
    """The rows of files; with ``rescue`` also what does not fit, and where it came from."""
    if fmt == "json" and rescue:
        files = [f for g in groups for f in g.files]
        text = spark.read.text(files).select("value", F.col("_metadata.file_path").alias("source_file"))
        rows = rescue_json(text, schema, case_sensitive=case_sensitive, path_col="source_file")
        return prepare(rows) if prepare else rows
    return read_mixed(spark, groups, fmt, schema, rescue, case_sensitive, prepare, **options)


def ingest_stream(spark: SparkSession, src: str, fmt: str, sink: str, checkpoint: str,
                  schema: SchemaLike | None = None, hints: str | None = None,
                  evolution: str = "addNewColumns", infer: bool = False,
                  prepare: Callable[[DataFrame], DataFrame] | None = None,
                  trigger: str | None = None, case_sensitive: bool = True,
                  **options: str) -> StreamingQuery:
    """Load new files of ``src`` into ``sink`` and stop when all are read; :func:`read_sink` reads it.

    With a declared ``schema`` it is fixed. Without one the columns are inferred from the files (all
    STRING unless ``infer``; Parquet and ORC say themselves), with ``hints`` on top, and kept in
    ``checkpoint/schema``; every micro-batch compares the files it is about to load with them, whenever these
    were written, each by its own footer or header line. New fields are treated by the ``evolution`` mode:
    ``addNewColumns`` records them, fails once with UnknownFieldError before a row is written, and the next run loads
    the same files with them; ``addNewColumnsWithTypeWidening`` does so with wider types, too.

    Columns are found by name. What does not fit goes to ``_rescued_data``: always in mode ``rescue``,
    and in every mode when the schema is inferred. ``case_sensitive`` decides about names in another case.
    Micro-batches have ``FILES_PER_BATCH`` files unless ``maxFilesPerTrigger`` is given.
    """
    reading = {k: v for k, v in options.items() if k not in CHOOSING}
    if fmt in ("parquet", "orc") and path_exists(spark, src):
        reading = {"basePath": src, **reading}  # folders may say the values of columns
    declared = schema is not None
    rescue = evolution == "rescue" or not declared
    if declared and not rescue and not (fmt == "csv" and has_header(options)):
        rows = read_stream(spark, src, fmt, schema, **{"maxFileAge": "36500d", **options})
        rows = prepare(rows) if prepare else rows
        save_schema(spark, f"{sink}/_schema", rows.schema)
        return append_stream(rows, sink, f"{checkpoint}/offsets", trigger)
    place = f"{checkpoint}/schema"
    if not declared:
        schema = load_schema(spark, place)
        if schema is None:
            first = list_files(spark, src, options.get("pathGlobFilter")).orderBy("modificationTime", "path")
            names = [r["path"] for r in first.select("path", "modificationTime").limit(SAMPLE_FILES).collect()]
            schema = recorded(schema_groups(spark, names, fmt, infer, hints, **reading), hints)
            save_schema(spark, place, schema)
    failures: list[UnknownFieldError] = []
    saved = [load_schema(spark, f"{sink}/_schema")]

    def load(batch: DataFrame, number: int) -> None:
        names = sorted(r["path"] for r in batch.collect())  # at most maxFilesPerTrigger
        groups = schema_groups(spark, names, fmt, infer and not declared, hints, schema if declared else None, **reading)
        if not declared:
            wider, verdict = evolve_schema(as_struct(schema), recorded(groups, hints), evolution)
            if verdict.action == "restart":
                save_schema(spark, place, wider)
            if verdict.action != "ok":
                failures.append(UnknownFieldError(verdict.new_fields + verdict.widened, verdict.action == "restart"))
                raise failures[-1]
        rows = _rows_of(spark, groups, fmt, schema, rescue, case_sensitive, reading, prepare)
        if rows.schema != saved[-1]:
            saved.append(rows.schema)
            save_schema(spark, f"{sink}/_schema", rows.schema)
        # A batch that is replayed writes the same place again.
        rows.write.mode("overwrite").parquet(f"{sink}/__batch={number}")

    writer = (_file_stream(spark, src, options).writeStream.foreachBatch(load)
              .option("checkpointLocation", f"{checkpoint}/offsets"))
    try:
        return _start(writer, trigger)
    except StreamingQueryException as e:
        raise (failures[-1] if failures else e) from None


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """The rows of a table written by :func:`ingest_stream`, in its recorded schema: columns that came
    later are NULL in rows that came before."""
    schema = load_schema(spark, f"{sink}/_schema")
    return spark.read.schema(schema).parquet(sink).select(*[F.col(f"`{c}`") for c in schema.names])


def follow_sink(spark: SparkSession, sink: str) -> DataFrame:
    """:func:`read_sink` as a stream."""
    schema = load_schema(spark, f"{sink}/_schema")
    return read_stream(spark, sink, "parquet", schema, maxFileAge="36500d").select(
        *[F.col(f"`{c}`") for c in schema.names])

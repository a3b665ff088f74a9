"""The streaming queries: topic -> queue table -> bronze table -> silver tables.

Every sink writes one folder per query and micro-batch and replaces it when the batch is run again, so a replay
after a crash leaves no second copy, and queries that share a table leave each other's folders alone. A query is
known by the id in its checkpoint. Offsets live in the checkpoint and move on only after the write.

Many small folders make reads slow: ``compact`` merges them into a keyed table beside them (``sources/keyed.py``), with
one row per key in ranges of message numbers. Readers collapse what is not compacted with the ranges it falls into, and
take all other ranges as they are. Silver tables follow the changes of the keyed table (``apply_changes``).
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from medallion.schemas import BRONZE_STREAM, RAW_EVENTS
from medallion.sources import keyed, versions
from medallion.sources.keyed import NO_VERSION, Keyed
from medallion.sources.tables import nullable, optional_table, overwrite_partitions, replace_table
from medallion.sources.versions import Version, escaped, file_system
from medallion.streaming.envelope import STREAM_PARTITIONS, accepted, parse_messages, raw_rows, rejected
from medallion.streaming.layers import BRONZE_KEY, NEWEST, PAYLOADS, TOPIC, PayloadSpec, collapse, payload_rows, topic_bronze_rows

EPOCH = "_epoch"
QUERY = "_query"
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
REJECTS = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.LongType()),
        T.StructField("offset", T.LongType()),
        T.StructField("message", T.StringType()),
    ]
)


def with_epoch(schema: T.StructType) -> T.StructType:
    """A stored stream table: its contract, and the query and micro-batch that wrote a row."""
    added = [T.StructField(QUERY, T.StringType()), T.StructField(EPOCH, T.LongType())]
    return T.StructType([*nullable(schema).fields, *added])


def with_topic(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(TOPIC, T.StringType())])


STORED_BRONZE = with_epoch(with_topic(BRONZE_STREAM))
KEYED_BRONZE = Keyed(STORED_BRONZE, (TOPIC, *BRONZE_KEY), "row_index", "tablet_index", NEWEST)
# Message numbers of one range: a million offsets of a topic's partition.
RANGE_BITS = 20
MERGED = "merged"


def now_text() -> F.Column:
    return F.date_format(F.current_timestamp(), ISO_MICROS)


def write_epoch(df: DataFrame, path: str, query: str, epoch: int, partition_by: Sequence[str] = ()) -> None:
    stamped = df.withColumns({QUERY: F.lit(query), EPOCH: F.lit(epoch).cast("long")})
    overwrite_partitions(stamped, path, [QUERY, EPOCH, *partition_by], balance=False)


def run_stream(
    stream: DataFrame,
    write: Callable[[DataFrame, str, int], None],
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Start a micro-batch query; without an interval it handles what is there and stops. ``write`` gets each batch
    with the id that the checkpoint keeps for the query, and the batch's number."""
    known, identity = threading.Event(), []

    def step(batch: DataFrame, epoch: int) -> None:
        known.wait()
        write(batch, identity[0], epoch)

    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    query = (writer.queryName(name) if name else writer).start()
    identity.append(str(query.id))
    known.set()
    return query


def topic_to_raw(
    messages: DataFrame,
    raw_path: str,
    rejects_path: str,
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Decode, route and store messages; what cannot be decoded is set aside with its offset."""

    def write(batch: DataFrame, query: str, epoch: int) -> None:
        parsed = parse_messages(batch).persist()
        try:
            rows = raw_rows(accepted(parsed), F.lit(f"{epoch:012d}"), now_text())
            write_epoch(rows, raw_path, query, epoch, ["tablet_index"])
            write_epoch(rejected(parsed), rejects_path, query, epoch)
        finally:
            parsed.unpersist()

    return run_stream(messages, write, checkpoint, every, name)


def read_queue(
    spark: SparkSession, raw_path: str, tablet_index: int | None = None, max_files: int | None = None
) -> DataFrame:
    """The queue table as a stream, whole or one queue partition."""
    reader = spark.readStream.schema(with_epoch(RAW_EVENTS))
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    stream = reader.parquet(raw_path)
    return stream if tablet_index is None else stream.where(F.col("tablet_index") == tablet_index)


def without_repeats(queue: DataFrame, within: str) -> DataFrame:
    """Queue rows whose message has not come in the time before, e.g. ``"2 hours"``. Keys are kept in the state store
    for that long after their first arrival and survive a restart.

    Time is when the stream reads a row, not a time in it: no row can be late, so none is dropped but repeats, and a
    repeat that comes after its key has left the state is collapsed on read like any other.
    """
    timed = queue.withColumn("_read_at", F.current_timestamp()).withWatermark("_read_at", within)
    return timed.dropDuplicatesWithinWatermark(["kafka_topic", "stream_id", "kafka_partition", "kafka_offset"]).drop("_read_at")


def raw_to_bronze(
    queue: DataFrame,
    bronze_path: str,
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
    once_within: str | None = None,
) -> StreamingQuery:
    """Append queue rows to bronze, one row per key within a batch. Keys that come again in a later batch
    are collapsed on read, or with ``once_within`` not written (see ``without_repeats``; it is fixed with the
    checkpoint). Start one query per queue partition to keep a failing one from stopping others."""
    if once_within is not None:
        queue = without_repeats(queue, once_within)

    def write(batch: DataFrame, query: str, epoch: int) -> None:
        rows = collapse(topic_bronze_rows(batch, now_text()))
        write_epoch(rows, bronze_path, query, epoch, ["tablet_index"])

    return run_stream(queue, write, checkpoint, every, name)


def bronze_table(bronze_root: str, tablet_index: int) -> str:
    """The path of one queue partition's own bronze table."""
    return f"{bronze_root.rstrip('/')}/bronze_t{tablet_index}"


def start_isolated(
    spark: SparkSession, raw_path: str, bronze_root: str, checkpoint_root: str, every: str | None = None
) -> dict[int, StreamingQuery]:
    """One query, table and checkpoint per queue partition, so that a failing one leaves the others running."""
    return {
        index: raw_to_bronze(
            read_queue(spark, raw_path, index),
            bronze_table(bronze_root, index),
            f"{checkpoint_root.rstrip('/')}/bronze_t{index}",
            every=every,
        )
        for index in sorted(set(STREAM_PARTITIONS.values()))
    }


def keyed_table(bronze_path: str) -> str:
    """The path of the keyed table that a bronze table is compacted into."""
    return f"{bronze_path.rstrip('/')}__keyed"


def stored_folders(spark: SparkSession, bronze_path: str) -> list[str]:
    """The folders of a bronze table, one per query, micro-batch and queue partition. Each appears as a whole."""
    files, root = file_system(spark, bronze_path)
    levels = "/".join(f"{name}=*" for name in (QUERY, EPOCH, "tablet_index"))
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{escaped(bronze_path.rstrip('/'))}/{levels}"))
    # Paths come back qualified; the last three names are the folder.
    return sorted("/".join(status.getPath().toUri().getPath().split("/")[-3:]) for status in found or [])


def _folder_rows(spark: SparkSession, bronze_path: str, folders: Sequence[str]) -> DataFrame | None:
    if not folders:
        return None
    root = bronze_path.rstrip("/")
    reader = spark.read.schema(nullable(STORED_BRONZE)).option("basePath", root)
    return reader.parquet(*(escaped(f"{root}/{folder}") for folder in folders)).select(*STORED_BRONZE.names)


def _state(spark: SparkSession, bronze_path: str) -> tuple[list[str], Version, list[str]]:
    """All folders, the keyed table's version, and the folders that it lacks. The folders are listed first: one that
    is deleted has been merged by a version before."""
    folders = stored_folders(spark, bronze_path)
    version = versions.latest(spark, keyed_table(bronze_path)) or NO_VERSION
    merged = set(version.notes.get(MERGED, ()))
    return folders, version, [folder for folder in folders if folder not in merged]


def read_bronze(spark: SparkSession, *bronze_paths: str, tablet_index: int | None = None) -> DataFrame:
    """Bronze with one row per key, from one table or from those of several queue partitions, which share no keys. A
    key's queue partition never changes, so one of them can be chosen first, and only its folders and ranges are read.
    Lists the folders, and runs a job that names the ranges of what is not compacted."""
    tables = []
    for path in bronze_paths:
        _, version, left = _state(spark, path)
        parts = None if tablet_index is None else {str(tablet_index)}
        fresh = _folder_rows(spark, path, [f for f in left if parts is None or keyed.range_of(f) in parts])
        if fresh is not None or version.number:
            tables.append(keyed.read_keyed(spark, keyed_table(path), KEYED_BRONZE, version, fresh, parts))
    if not tables:
        return spark.createDataFrame([], nullable(BRONZE_STREAM))
    return reduce(DataFrame.unionByName, tables).select(*BRONZE_STREAM.names)


def compact(spark: SparkSession, bronze_path: str, range_bits: int = RANGE_BITS) -> int:
    """Merge the folders of a bronze table into its keyed table; returns how many micro-batches' folders were there.

    Only ranges with rows of folders that were not merged before are rewritten. Rows and the list of merged folders
    are published together; of two runs that meet, one gives way and merges nothing. The folders stay, for streams
    that still read them and for a micro-batch that is run again, until ``drop_merged``. ``range_bits`` counts at the
    first call: a table keeps the width of its ranges.
    """
    folders, version, left = _state(spark, bronze_path)
    if left:
        notes = {MERGED: folders}
        bits = keyed.range_bits(version, range_bits)
        fresh = _folder_rows(spark, bronze_path, left)
        keyed.merge(fresh, keyed_table(bronze_path), KEYED_BRONZE, version, bits, notes)
    return len({folder.rsplit("/", 1)[0] for folder in folders})


def drop_merged(spark: SparkSession, bronze_path: str) -> None:
    """Delete the merged folders. Call it when nobody has to read them any more."""
    folders, _, left = _state(spark, bronze_path)
    files, root = file_system(spark, bronze_path)
    for folder in set(folders) - set(left):
        place = spark._jvm.org.apache.hadoop.fs.Path(root, folder)
        files.delete(place, True)
        if not files.listStatus(place.getParent()):
            files.delete(place.getParent(), False)


def rebuild_silver(spark: SparkSession, bronze_path: str | Sequence[str], spec: PayloadSpec, path: str) -> None:
    """The full refresh of one silver table, from one bronze table or those of the queue partitions."""
    paths = [bronze_path] if isinstance(bronze_path, str) else bronze_path
    rows = read_bronze(spark, *paths, tablet_index=spec.tablet_index)
    replace_table(payload_rows(rows, spec, now_text()), path)


def keyed_silver(spec: PayloadSpec) -> Keyed:
    return Keyed(with_topic(spec.schema), (TOPIC, *BRONZE_KEY), "row_index", "tablet_index")


def apply_changes(spark: SparkSession, bronze_path: str | Sequence[str], spec: PayloadSpec, path: str) -> int:
    """Bring one silver table up to the keyed tables of bronze: rows that came or were replaced since the versions
    that the silver table has seen. What is not compacted yet is left for the next call. A row that is no longer of
    the table's source goes. A table that was not kept this way is made anew. Returns how many bronze tables had changed.

    The versions seen are published with the rows, so a call that fails or gives way to another one has done nothing.
    """
    kept, done = keyed_silver(spec), 0
    for bronze in [bronze_path] if isinstance(bronze_path, str) else bronze_path:
        source, now = keyed_table(bronze), versions.latest(spark, path) or NO_VERSION
        with_notes = now.notes if keyed.BITS in now.notes else {}
        seen, newest = with_notes.get(source, 0), versions.latest(spark, source)
        if newest is None or newest.number == seen:
            continue
        rows = keyed.changed_since(spark, source, KEYED_BRONZE, newest, seen)
        rows = rows.where(F.col("tablet_index") == spec.tablet_index)
        typed = payload_rows(rows, spec, now_text(), keep=[TOPIC]).withColumn(keyed.GONE, F.lit(False))
        # A key that the table can't have needs no removal.
        left = rows.where((F.col(keyed.FIRST) <= seen) & ~F.col("source").eqNullSafe(F.lit(spec.source)))
        gone = left.select(TOPIC, *BRONZE_KEY, "tablet_index", F.lit(True).alias(keyed.GONE))
        fresh = typed.unionByName(gone, allowMissingColumns=True)
        bits = keyed.range_bits(newest, RANGE_BITS)
        if keyed.merge(fresh, path, kept, now, bits, {**with_notes, source: newest.number}) is not None:
            done += 1
    return done


def bronze_to_silver(
    bronze: DataFrame, paths: dict[str, str], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Incremental twin of ``rebuild_silver`` for all silver tables at once."""

    def write(batch: DataFrame, query: str, epoch: int) -> None:
        batch.persist()
        try:
            for name, path in paths.items():
                spec = PAYLOADS[name]
                write_epoch(payload_rows(batch, spec, now_text(), keep=[TOPIC]), path, query, epoch)
        finally:
            batch.unpersist()

    return run_stream(bronze, write, checkpoint, every)


def stream_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    return spark.readStream.schema(STORED_BRONZE).parquet(bronze_path)


def read_silver(spark: SparkSession, path: str, spec: PayloadSpec) -> DataFrame:
    """An incrementally kept silver table; a key that came again counts once."""
    stored = with_epoch(T.StructType([*spec.schema.fields, T.StructField(TOPIC, T.StringType())]))
    found = optional_table(spark, path, stored)
    return spark.createDataFrame([], nullable(spec.schema)) if found is None else collapse(found).select(*spec.schema.names)

"""Versions of a table: a log of manifests beside its data.

Rows are written into folders of their own, one per attempt, and count when a manifest names them. A manifest is the
whole list of a version; it is published by creating the file of the next number, which only one writer can do. So a
reader that took a version reads the same folders until the end, whatever is published meanwhile, a writer that fails
changes nothing, and nobody has to repair anything. Folders are never written to again, so naming them is naming
their files; a manifest is as long as the table has folders.

    <table>/_log/00000000000000000007.json    <table>/_data/_attempt=<id>[/<partition>=<value>...]/part-...

The folder names start with an underscore: a plain scan of the table's path fails instead of mixing versions.

The file system must rename without replacing, as HDFS and those that Spark's own streaming logs need; local folders
use hard links.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LOG, DATA, ATTEMPT, PINS = "_log", "_data", "_attempt", "pins"
# Versions that are kept without being pinned: the current one, and the one that readers may be in the middle of.
KEEP = 2
_NAME = re.compile(r"^(\d{20})\.json$")
_GLOB = re.compile(r"([\\*?\[\]{}])")
_TRIES = 100


@dataclass(frozen=True)
class Entry:
    """The folders of one attempt. An entry that is not ``final`` counts when its attempt stands in a ledger."""

    attempt: str
    folders: tuple[str, ...]
    final: bool = True


@dataclass(frozen=True)
class Version:
    """``notes`` are what the writer of a version wants to know next time; the next version keeps them unless it is
    given others."""

    number: int
    entries: tuple[Entry, ...]
    schema: str | None = None
    notes: dict = field(default_factory=dict)

    @property
    def folders(self) -> set[str]:
        return {folder for entry in self.entries for folder in entry.folders}

    def text(self) -> str:
        entries = [[entry.attempt, list(entry.folders), entry.final] for entry in self.entries]
        return json.dumps({"number": self.number, "schema": self.schema, "entries": entries, "notes": self.notes})

    @staticmethod
    def parsed(text: str) -> Version:
        found = json.loads(text)
        entries = tuple(Entry(attempt, tuple(folders), final) for attempt, folders, final in found["entries"])
        return Version(found["number"], entries, found["schema"], found.get("notes", {}))


def file_system(spark: SparkSession, path: str):
    """The file system and the path as it knows it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def escaped(place: str) -> str:
    """A place as a path pattern that matches itself alone."""
    return _GLOB.sub(r"\\\1", place)


def nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


def _numbers(spark: SparkSession, path: str) -> list[int]:
    files, log = file_system(spark, f"{path.rstrip('/')}/{LOG}")
    if not files.exists(log):
        return []
    names = (status.getPath().getName() for status in files.listStatus(log))
    return sorted(int(match[1]) for name in names if (match := _NAME.match(name)))


def _manifest(spark: SparkSession, path: str, number: int):
    return file_system(spark, f"{path.rstrip('/')}/{LOG}/{number:020d}.json")


def read_version(spark: SparkSession, path: str, number: int) -> Version:
    files, place = _manifest(spark, path, number)
    stream = files.open(place)
    try:
        return Version.parsed(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def latest(spark: SparkSession, path: str) -> Version | None:
    """The newest version; None where there is no log."""
    numbers = _numbers(spark, path)
    return read_version(spark, path, numbers[-1]) if numbers else None


def _is(error: Py4JJavaError, kind: str) -> bool:
    return error.java_exception.getClass().getSimpleName() == kind


def publish(spark: SparkSession, path: str, version: Version) -> bool:
    """Create the manifest of a version; False if that number is there already. It appears whole or not at all."""
    files, place = _manifest(spark, path, version.number)
    jvm = spark._jvm
    files.mkdirs(place.getParent())
    draft = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{uuid.uuid4().hex}.draft")
    out = files.create(draft, False)
    try:
        out.write(bytearray(version.text().encode()))
    finally:
        out.close()
    try:
        uri = files.makeQualified(place).toUri()
        if uri.getScheme() == "file":
            as_file = jvm.java.io.File
            jvm.java.nio.file.Files.createLink(as_file(uri.getPath()).toPath(), as_file(files.makeQualified(draft).toUri().getPath()).toPath())
        else:
            kind = jvm.org.apache.hadoop.fs.Options.Rename
            options = spark.sparkContext._gateway.new_array(kind, 1)
            options[0] = kind.NONE
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, spark._jsparkSession.sessionState().newHadoopConf())
            context.rename(files.makeQualified(draft), files.makeQualified(place), options)
    except Py4JJavaError as error:
        if not _is(error, "FileAlreadyExistsException"):
            raise
        return False
    finally:
        files.delete(draft, False)
    return True


def change(
    spark: SparkSession,
    path: str,
    step: Callable[[Version], Sequence[Entry] | None],
    schema: str | None = None,
    notes: dict | None = None,
) -> Version | None:
    """Publish what ``step`` makes of the newest version's entries, anew if another writer was first. None if it
    makes nothing of them."""
    for _ in range(_TRIES):
        now = latest(spark, path) or Version(0, ())
        entries = step(now)
        if entries is None:
            return None
        after = Version(now.number + 1, tuple(entries), schema or now.schema, now.notes if notes is None else notes)
        if publish(spark, path, after):
            return after
    raise RuntimeError(f"{_TRIES} other writers were first at {path}")


def write_attempt(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), attempt: str | None = None, final: bool = True
) -> Entry:
    """Write rows into folders of a new attempt. They count when its entry is published. A failed write leaves none."""
    spark, attempt = df.sparkSession, attempt or uuid.uuid4().hex
    base = f"{path.rstrip('/')}/{DATA}/{ATTEMPT}={attempt}"
    files, root = file_system(spark, base)
    try:
        df.write.mode("errorifexists").partitionBy(*partition_by).parquet(base)
    except Exception:
        files.delete(root, True)
        raise
    if not partition_by:
        return Entry(attempt, (f"{ATTEMPT}={attempt}",), final)
    leaves = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path("/".join([escaped(base), *(f"{name}=*" for name in partition_by)])))
    cut = len(root.getParent().toUri().getPath()) + 1
    folders = sorted(leaf.getPath().toUri().getPath()[cut:] for leaf in leaves)
    return Entry(attempt, tuple(folders), final)


def drop_attempt(spark: SparkSession, path: str, attempt: str) -> None:
    files, place = file_system(spark, f"{path.rstrip('/')}/{DATA}/{ATTEMPT}={attempt}")
    files.delete(place, True)


def rows_of(
    spark: SparkSession,
    path: str,
    version: Version,
    schema: T.StructType | None = None,
    folders: Sequence[str] | None = None,
    with_attempt: bool = False,
) -> DataFrame:
    """The rows of a version, or of some of its folders; on request with the attempt that wrote them."""
    if folders is None:
        folders = sorted(folder for entry in version.entries if entry.final for folder in entry.folders)
    known = schema or T.StructType.fromJson(json.loads(version.schema))
    stored = T.StructType([*nullable(known).fields, T.StructField(ATTEMPT, T.StringType())])
    names = stored.names if with_attempt else known.names
    if not folders:
        return spark.createDataFrame([], stored).select(*names)
    base = f"{path.rstrip('/')}/{DATA}"
    reader = spark.read.schema(stored).option("basePath", base)
    # Partition columns come last in a parquet folder; put them back in contract order.
    return reader.parquet(*(escaped(f"{base}/{folder}") for folder in folders)).select(*names)


def replace_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> Version:
    """Full refresh: the next version holds the rows of ``df`` alone. ``df`` may read the version it replaces."""
    spark, schema = df.sparkSession, df.schema.json()
    entry = write_attempt(df, path, partition_by)
    try:
        published = change(spark, path, lambda now: [entry], schema, {})
    except Exception:
        drop_attempt(spark, path, entry.attempt)
        raise
    expire(spark, path)
    return published


def add_entry(spark: SparkSession, path: str, entry: Entry, schema: T.StructType) -> Version:
    return change(spark, path, lambda now: [*now.entries, entry], schema.json())


@contextmanager
def pinned(spark: SparkSession, path: str) -> Iterator[Version]:
    """The newest version, kept whole until the block ends."""
    while True:
        number = _numbers(spark, path)[-1]
        files, pin = file_system(spark, f"{path.rstrip('/')}/{LOG}/{PINS}/{number:020d}-{uuid.uuid4().hex}")
        files.create(pin, False).close()
        # It may have expired before the pin was there.
        if number in _numbers(spark, path):
            break
        files.delete(pin, False)
    try:
        yield read_version(spark, path, number)
    finally:
        files.delete(pin, False)


def expire(spark: SparkSession, path: str, keep: int = KEEP) -> int:
    """Drop versions that are neither pinned nor among the last ``keep``, and the folders that no other version names;
    returns how many folders. Attempts that were never published are left alone: they may be under way."""
    root = path.rstrip("/")
    numbers = _numbers(spark, path)
    files, pins = file_system(spark, f"{root}/{LOG}/{PINS}")
    held = {int(status.getPath().getName().split("-")[0]) for status in files.listStatus(pins)} if files.exists(pins) else set()
    gone = [number for number in numbers[:-keep] if number not in held]
    if not gone:
        return 0
    kept = set().union(*(read_version(spark, path, number).folders for number in numbers if number not in gone))
    dropped = set().union(*(read_version(spark, path, number).folders for number in gone)) - kept
    for folder in sorted(dropped):
        place = file_system(spark, f"{root}/{DATA}/{folder}")[1]
        files.delete(place, True)
        if place.getParent().getName() != DATA and not files.listStatus(place.getParent()):
            files.delete(place.getParent(), True)
    for number in gone:
        files.delete(_manifest(spark, path, number)[1], False)
    return len(dropped)


def _day(folder: str) -> str:
    return folder.split("/", 1)[1]


def merge_folders(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    partition_by: Sequence[str],
    layout: Callable[[DataFrame], DataFrame],
    committed: Callable[[Sequence[str]], set[str]],
    at_once: int = 64,
) -> int:
    """Write the rows of every partition that lies in several folders into one, ``at_once`` partitions a version;
    returns how many partitions. ``committed`` says which attempts that are not final count; others stay as they are.
    Old folders go with the versions that name them."""
    merged = 0
    version = latest(spark, path)
    if version is None:
        return 0
    done = committed([entry.attempt for entry in version.entries if not entry.final])
    by_day: dict[str, list[str]] = {}
    for entry in version.entries:
        if entry.final or entry.attempt in done:
            for folder in entry.folders:
                by_day.setdefault(_day(folder), []).append(folder)
    crowded = sorted(day for day, folders in by_day.items() if len(folders) > 1)
    for start in range(0, len(crowded), at_once):
        old = {folder for day in crowded[start : start + at_once] for folder in by_day[day]}
        new = write_attempt(layout(rows_of(spark, path, version, schema, sorted(old))), path, partition_by)

        def step(now: Version, old: set[str] = old, new: Entry = new) -> list[Entry] | None:
            if not old <= now.folders:
                return None  # another run was here first
            left = [Entry(e.attempt, tuple(f for f in e.folders if f not in old), e.final) for e in now.entries]
            return [*(entry for entry in left if entry.folders), new]

        if change(spark, path, step) is None:
            drop_attempt(spark, path, new.attempt)
        else:
            merged += len(crowded[start : start + at_once])
    expire(spark, path)
    return merged

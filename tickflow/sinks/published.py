"""The published result: append-only JSON lines by year, month and day.

Every write owns one ``batch=`` folder in each day it touches. Writing the same
batch again replaces exactly those folders, so a repeated write neither loses nor
doubles rows, and readers never see files of an unfinished write. Which folders of a day
count is written in its manifest (``sinks.manifest``), so many can be replaced at once.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tickflow.functions.scalar import date_keys
from tickflow.schemas import PARTITIONS, RESULT
from tickflow.sinks.manifest import Day, Entry, Store, day_folder, each

# Fixed value: how zone-less times are written in result files.
LOCAL_TIME = "yyyy-MM-dd HH:mm:ss"

MARKER = "_SUCCESS"

_BATCH_NAME = re.compile(r"[A-Za-z0-9._-]+")


def result_columns(ranked: DataFrame) -> DataFrame:
    """The published columns in their order, with the partition keys."""
    return ranked.select(*RESULT.names, *date_keys("window_start"))


def write_options(writer):
    """A batch or stream writer with the options of result files."""
    return writer.option("ignoreNullFields", "false").option("timestampNTZFormat", LOCAL_TIME)


def write_published(result: DataFrame, root: str, batch: str, tasks: int | None = None) -> None:
    """Write a result as ``batch``, replacing an earlier attempt of that batch. In days that
    have a manifest it counts once ``publish_result`` has added it there.

    Each day is gathered into one of ``tasks`` tasks first: otherwise every task
    would leave a small file in every day. A day has only the top rows of its
    windows, so it fits. The number is given and not left to Spark, which would
    merge small days into one task that then creates all their files in turn.
    """
    tasks = tasks or int(result.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    gathered = result.repartition(tasks, *PARTITIONS.names).withColumn("batch", F.lit(batch))
    (
        write_options(gathered.write)
        .format("json")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS.names, "batch")
        .save(root)
    )


def touched_days(result: DataFrame) -> list[Row]:
    """The distinct year, month and day of a result: one entry per day, never rows."""
    return result.select(*PARTITIONS.names).distinct().collect()


def _each(spark: SparkSession, paths: list[str], action) -> None:
    """Call ``action(file_system, path)`` on the output store, several at a time."""
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()

    def call(text: str) -> None:
        path = path_of(text)
        action(path.getFileSystem(conf), path)

    with ThreadPoolExecutor(max_workers=16) as pool:
        list(pool.map(call, paths))


def _found(spark: SparkSession, root: str, name: str) -> list[str]:
    """Paths of ``name`` in all days. Spark's readers hide markers, so it is looked up."""
    levels = "/".join(f"{key}=*" for key in PARTITIONS.names)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{levels}/{name}")
    store = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    return [str(status.getPath()) for status in store.globStatus(pattern) or []]


def _keys(path: str) -> tuple[str, ...]:
    return tuple(part.split("=", 1)[1] for part in path.split("/")[-4:-1])


def mark_partitions(spark: SparkSession, root: str, days: list[Row]) -> None:
    """Put an empty marker into each of ``days``.

    Run after the write was committed; repeating it changes nothing.
    """
    markers = [f"{day_folder(root, day)}/{MARKER}" for day in days]
    _each(spark, markers, lambda store, path: store.create(path, True).close())


def marked_days(spark: SparkSession, root: str) -> DataFrame:
    """The year, month and day of every partition that carries a marker."""
    return spark.createDataFrame([_keys(path) for path in _found(spark, root, MARKER)], PARTITIONS)


def drop_other_days(spark: SparkSession, root: str, batch: str, days: list[Row]) -> None:
    """Remove what an earlier run of ``batch`` left in days that it no longer has."""
    kept = {tuple(day) for day in days}
    store = Store(spark, root)
    stale = [_keys(path) for path in _found(spark, root, f"batch={batch}") if _keys(path) not in kept]

    def drop(day: Day) -> None:
        store.commit(day, lambda entries: tuple(e for e in entries if e.batch != batch))
        store.delete(f"{day_folder(root, day)}/batch={batch}")

    each(stale, drop)


def _add(batch: str, rerun: bool):
    """The change of a day's manifest that adds a write of ``batch`` as the newest."""

    def change(entries: tuple[Entry, ...]) -> tuple[Entry, ...] | None:
        if any(e.holds(batch) for e in entries):
            if rerun:
                raise ValueError(f"{batch} was compacted with others and cannot be replaced any more")
            # A micro-batch that is run again: its rows are there.
            return None
        return (*(e for e in entries if e.batch != batch), Entry(batch))

    return change


def _commit(spark: SparkSession, root: str, batch: str, days: list[Day], rerun: bool) -> None:
    """Let a finished write count."""
    store = Store(spark, root)

    def one(day: Day) -> None:
        if batch not in [e.batch for e in store.commit(day, _add(batch, rerun))]:
            store.delete(f"{day_folder(root, day)}/batch={batch}")

    each(days, one)


def compact_days(spark: SparkSession, root: str, batch: str, days: list[Day] | None = None) -> None:
    """Gather the ``batch=`` folders of finished days, each into one; all days by default.

    One Spark job writes all days beside the result, under a name that readers skip. Then
    each day's folder is put in its place, and the day's manifest names it in place of the
    old ones, which go. A reader sees the old folders until that moment and the new one from
    then on. What was added to a day meanwhile stays; a day of which something was replaced
    meanwhile is left as it is. A run that was cut short can be run again.
    """
    store = Store(spark, root)
    known = store.manifests()
    days = list(known) if days is None else days
    found = {day: known[day] for day in days if day in known}
    before = {
        day: m.entries if m.number else tuple(Entry(b) for b in store.folders(day)) for day, m in found.items()
    }
    # One that was compacted already stays.
    before = {day: entries for day, entries in before.items() if len(entries) > 1 or any(not e.of for e in entries)}
    if not before:
        return
    from tickflow.sources.published import read_batches

    waiting = f"{root}/_{batch}"
    paths = [f"{day_folder(root, day)}/batch={e.batch}" for day, entries in before.items() for e in entries]
    rows = read_batches(spark, root, paths)
    most = int(spark.conf.get("spark.sql.shuffle.partitions"))
    gathered = rows.repartition(min(len(before), most), *PARTITIONS.names)
    write_options(gathered.write).mode("overwrite").partitionBy(*PARTITIONS.names).json(waiting)

    def swap(day: Day) -> None:
        old, folder = before[day], day_folder(root, day)
        taken = [e.batch for e in old]
        name = f"{batch}-{found[day].number + 1}" if batch in taken else batch
        new = Entry(name, of=tuple(b for e in old for b in (e.of or (e.batch,))))
        target = f"{folder}/batch={name}"
        store.delete(target)  # of a run that was cut short here
        store.rename(day_folder(waiting, day), target)
        done = []

        def change(entries: tuple[Entry, ...]) -> tuple[Entry, ...] | None:
            done.clear()
            # Without a list before, the names are all there is to compare.
            same = (lambda e: e.id) if found[day].number else (lambda e: e.batch)
            here = {same(e) for e in entries}
            if not all(same(e) in here for e in old):
                return None
            gone = {same(e) for e in old}
            done.append(True)
            return (new, *(e for e in entries if same(e) not in gone))

        store.commit(day, change)
        for e in old if done else [new]:
            store.delete(f"{folder}/batch={e.batch}")

    each(before, swap)
    store.delete(waiting)


def compact_day(spark: SparkSession, root: str, day: Row, batch: str) -> None:
    """``compact_days`` for one day."""
    compact_days(spark, root, batch, [tuple(day[name] for name in PARTITIONS.names)])


def publish_result(result: DataFrame, root: str, batch: str, rerun: bool = False) -> None:
    """Write ``batch`` and mark the days it touched.

    Repeating it with the same rows changes nothing. With ``rerun`` the rows may
    differ from an earlier run: then that run's folders in other days are removed.
    """
    if not _BATCH_NAME.fullmatch(batch):
        raise ValueError(f"batch names are made of letters, digits, '.', '_' and '-': {batch!r}")
    result = result.persist()
    try:
        spark = result.sparkSession
        days = touched_days(result)
        if days:
            most = int(spark.conf.get("spark.sql.shuffle.partitions"))
            write_published(result, root, batch, min(len(days), most))
            _commit(spark, root, batch, [tuple(day) for day in days], rerun)
            mark_partitions(spark, root, days)
        if rerun:
            drop_other_days(spark, root, batch, days)
    finally:
        result.unpersist()

"""Tables that streams add to: folders by day, merged level by level, expired without a rewrite.

Each batch adds one folder per day it touched. A manifest names the folders that count; a reader takes
it once and lists nothing else. When a day has enough folders of one level, they are merged into one
of the next, so a day keeps a number of folders that grows with the logarithm of its batches. Merging
and expiry only write a new manifest: what they replace stays on disk for readers that are under way,
until ``vacuum`` removes it.

One writer at a time changes a table; the manifest is written as a version that must not exist yet,
so that a second writer fails instead of undoing the first.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable, Sequence
from datetime import date, datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.session import _WRITERS, listed, open_folders, remove

DAY = "day"
#: Folders of one level and day that are merged into one of the next.
FANOUT = 8
#: Tasks that share a day's rows when these are made more after the shuffle, at least.
PIECES = 4
#: Manifests kept for readers that look while newer ones are written.
VERSIONS_KEPT = 20

_ENTRY = "part string, day date, level int, last_batch long"
#: Level of the row that only says which batch was added last; every manifest has one.
_MARK = -1
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_PIECE = "_piece"


class Entry(NamedTuple):
    """A live folder: a part's rows of one day."""

    part: str
    day: date | None
    level: int

    def path(self, table: str) -> str:
        name = _NO_DAY if self.day is None else self.day.isoformat()
        return f"{table}/data/part={self.part}/{DAY}={name}"


class Manifest(NamedTuple):
    version: int
    last_batch: int
    entries: list[Entry]


def manifest(spark: SparkSession, table: str) -> Manifest:
    """The newest manifest; an empty one, version -1, where there is none.

    Its rows come to the driver: days times the folders a day keeps.
    """
    try:
        rows = spark.read.schema(f"{_ENTRY}, version long").parquet(f"{table}/manifest").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = []
    newest = max((r.version for r in rows), default=-1)
    own = [r for r in rows if r.version == newest]
    marks = [r.last_batch for r in own if r.level == _MARK]
    return Manifest(newest, max(marks, default=-1), [Entry(*r[:3]) for r in own if r.level != _MARK])


def _commit(spark: SparkSession, table: str, old: Manifest, entries: Sequence[Entry], last_batch: int) -> Manifest:
    """Write the next manifest and return it. It is one file, so readers see all of it or nothing."""
    version = old.version + 1
    rows = [(*e, None) for e in entries] + [("", None, _MARK, last_batch)]
    spark.createDataFrame(rows, _ENTRY).coalesce(1).write.mode("error").parquet(f"{table}/manifest/version={version}")
    if version >= VERSIONS_KEPT:
        remove(spark, f"{table}/manifest/version={version - VERSIONS_KEPT}")
    return Manifest(version, last_batch, list(entries))


def _near(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows (with ``day``) shuffled so that few files a day hold them."""
    return rows.hint("rebalance", *map(F.col, (DAY, *by)))


def _written(rows: DataFrame, table: str, level: int, by: Sequence[str]) -> list[Entry]:
    """Write rows (with ``day``) as a new part and return its folders."""
    spark, part = rows.sparkSession, uuid.uuid4().hex
    folder = f"{table}/data/part={part}"
    with open_folders(spark):
        rows.write.partitionBy(DAY, *by).parquet(folder)
    names = [name.split("=", 1)[1] for name, _ in listed(spark, folder) if name.startswith(f"{DAY}=")]
    return [Entry(part, None if n == _NO_DAY else date.fromisoformat(n), level) for n in sorted(names)]


def add_batch(
    rows: DataFrame, table: str, batch_id: int, by: Sequence[str] = (), ts: str = "ts",
    combine: Callable[[DataFrame], DataFrame] | None = None, fanout: int = FANOUT,
    expand: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Add a batch's rows once, and merge what has become enough for it.

    Batches come in the order of their numbers. A batch that was added before is left out, so a stream
    may repeat it; one that died on the way left a part that no manifest names. ``by`` are columns by
    which a day is divided further, ``ts`` the time that gives the day, ``combine`` what merging does
    to rows besides putting them together. ``expand`` makes the table's rows, many of one, of those
    given, and keeps ``ts`` and ``by``; it is called on rows that are shuffled already, so that only
    the few are.
    """
    spark = rows.sparkSession
    old = manifest(spark, table)
    if batch_id <= old.last_batch:
        return
    dated = rows.withColumn(DAY, F.to_date(ts))
    if expand is None:
        dated = _near(dated, by)
    else:
        pieces = dated.withColumn(_PIECE, F.pmod(F.xxhash64(ts), F.lit(PIECES)))
        dated = expand(_near(pieces, [*by, _PIECE]).drop(DAY, _PIECE)).withColumn(DAY, F.to_date(ts))
    added = _written(dated, table, 0, by)
    _merged(spark, table, _commit(spark, table, old, [*old.entries, *added], batch_id), by, combine, fanout)


def merge(
    spark: SparkSession, table: str, by: Sequence[str] = (),
    combine: Callable[[DataFrame], DataFrame] | None = None, fanout: int = FANOUT,
) -> int:
    """Merge the folders of every day and level that has ``fanout`` of them; returns how many went.

    Level by level from below, one job and one manifest for all days of a level.
    """
    return _merged(spark, table, manifest(spark, table), by, combine, fanout)


def _merged(
    spark: SparkSession, table: str, now: Manifest, by: Sequence[str],
    combine: Callable[[DataFrame], DataFrame] | None, fanout: int,
) -> int:
    went, level = 0, 0
    while level <= max((e.level for e in now.entries), default=-1):
        days = defaultdict(list)
        for entry in now.entries:
            if entry.level == level:
                days[entry.day].append(entry)
        old = [e for own in days.values() if len(own) >= fanout for e in own]
        if old:
            rows = _read(spark, table, old)
            made = _written(_near(combine(rows) if combine else rows, by), table, level + 1, by)
            gone = set(old)
            now = _commit(spark, table, now, [e for e in now.entries if e not in gone] + made, now.last_batch)
            went += len(old)
        level += 1
    return went


def _read(spark: SparkSession, table: str, entries: Sequence[Entry]) -> DataFrame:
    paths = [e.path(table) for e in entries]
    return spark.read.option("basePath", f"{table}/data").parquet(*paths).drop("part").withColumn(
        DAY, F.col(DAY).cast("date"))


def read_table(
    spark: SparkSession, table: str, first: date | None = None, last: date | None = None,
    schema: str | None = None,
) -> DataFrame:
    """The rows that the newest manifest names, with ``day``; days outside the range are not listed.

    Rows without a day count as in every range. Where no folder is left, the rows of ``schema``, which
    are none; without a schema that is an error, like a table that was never written.
    """
    live = [
        e for e in manifest(spark, table).entries
        if e.day is None or (first is None or e.day >= first) and (last is None or e.day <= last)
    ]
    if live:
        return _read(spark, table, live)
    if schema is None:
        raise FileNotFoundError(f"no folder of {table} is in its manifest")
    return spark.createDataFrame([], schema)


def expire(spark: SparkSession, table: str, first: date) -> int:
    """Drop the days before ``first`` from the table; returns how many folders went."""
    old = manifest(spark, table)
    kept = [e for e in old.entries if e.day is None or e.day >= first]
    if len(kept) < len(old.entries):
        _commit(spark, table, old, kept, old.last_batch)
    return len(old.entries) - len(kept)


def vacuum(spark: SparkSession, table: str, before: datetime) -> int:
    """Remove the folders that no kept manifest names and that were last changed before a time.

    The time must lie before the start of every reader and writer that is still under way. Returns
    how many folders were removed.
    """
    try:
        rows = spark.read.schema(_ENTRY).parquet(f"{table}/manifest").select("part", "day").distinct().collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    named = {Entry(r.part, r.day, 0).path("") for r in rows}
    removed = 0
    for part, _ in listed(spark, f"{table}/data"):
        days = listed(spark, f"{table}/data/{part}")
        old = [d for d, changed in days if f"/data/{part}/{d}" not in named and changed < before.timestamp()]
        for name in [part] if len(old) == len(days) else [f"{part}/{d}" for d in old]:
            remove(spark, f"{table}/data/{name}")
        removed += sum(d.startswith(f"{DAY}=") for d in old)
    return removed

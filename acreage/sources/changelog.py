"""A table's commits, each kept as the changes it made."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from acreage.operators.changes import change_feed
from acreage.operators.feed import KIND, TIME, VERSION
from acreage.sources.writers import Lake

# Names of the folders a commit's changes lie in.
NUMBER, MICROS = "commit_version", "commit_micros"


def micros(moment: datetime) -> int:
    """Microseconds since 1970; a moment without a zone is UTC."""
    moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    since = moment - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return (since.days * 86_400 + since.seconds) * 1_000_000 + since.microseconds


class ChangeLog:
    """The change feed of one table of a lake.

    A commit's version and time are names of the folders around its changes, so a range of
    versions or times is read without opening other commits. A commit is there when its success
    mark is, and one without changes is a version too. One writer at a time.
    """

    def __init__(self, lake: Lake, table: str, layout: T.StructType, keys: Sequence[str]):
        self.lake, self.table, self.layout, self.keys = lake, table, layout, list(keys)
        marks = [T.StructField(NUMBER, T.LongType()), T.StructField(MICROS, T.LongType())]
        self.stored = T.StructType([*layout.fields, T.StructField(KIND, T.StringType()), *marks])

    def last(self) -> tuple[int, int] | None:
        """Version and time, in microseconds, of the last commit."""
        found = self.lake.marks(self.table)
        return (found[NUMBER], found[MICROS]) if found else None

    def commit(self, old: DataFrame, new: DataFrame, moment: datetime) -> int:
        """Append what turns one state into the next, and return the commit's version."""
        return self.append(change_feed(old, new, self.keys), moment)

    def append(self, changes: DataFrame, moment: datetime) -> int:
        """Append changes with their ``_change_type`` as the next version, counted from 0."""
        last, at = self.last(), micros(moment)
        if last and at < last[1]:
            raise ValueError(f"commit at {moment} is older than the last one; commits are in order of time")
        version = last[0] + 1 if last else 0
        self.lake.append(self.table, changes, self.stored, {NUMBER: version, MICROS: at})
        return version

    def between(
        self,
        first: int | None = None,
        last: int | None = None,
        since: datetime | None = None,
        until: datetime | None = None,
    ) -> DataFrame:
        """The changes of a range of commits, both ends included, by version or time or both, with
        ``_commit_version`` and ``_commit_timestamp``. A range that holds no commit has no rows."""
        rows = self.lake.read(self.table, self.stored)
        for column, low, high in ((NUMBER, first, last), (MICROS, since and micros(since), until and micros(until))):
            if low is not None:
                rows = rows.where(F.col(column) >= low)
            if high is not None:
                rows = rows.where(F.col(column) <= high)
        return rows.select(*self.layout.names, KIND, F.col(NUMBER).alias(VERSION), F.timestamp_micros(MICROS).alias(TIME))

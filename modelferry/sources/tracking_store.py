"""The tracking table on storage (S4, S5), its commits and its change log.

Each state of the table is a complete dataset ``<path>/state=<number>``. Outcomes that arrive one batch after the other do not
rewrite it: each batch is a small dataset ``change=<number>`` of the rows it brought, and a reader lays the newest
outcome of each model over the state. Applying an outcome twice has no further effect, so it does not matter whether a
reader meets it once or twice. After ``MERGE_AFTER`` changes their newest rows are put together as ``merged=<number>``,
and once these are ``FOLD_AT`` of the table's rows the table is written anew. So what is written follows what
arrives: a row of a batch is rewritten a few times, and the table only for as many outcomes as a share of its rows.

All numbers are one sequence. Spark's ``_SUCCESS`` file makes a dataset valid, and the highest valid state is current with the valid
changes after it, so a reader never sees half a dataset and a plan never overwrites what it reads.
One writer at a time: each claims its number by a file that only one can create, so
a second one that starts from the same state fails. The newest ``KEPT`` states stay, for readers that began
before the last change; older ones are deleted. Where a table format offers MERGE, use
:func:`merge_statement` on its table instead.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from modelferry.operators.upsert import apply_latest, newest
from modelferry.schemas import POSITION, SOURCE_COLUMNS, TRACKING, TRACKING_KEYS
from modelferry.sources import storage

_STATE, _CHANGE, _MERGED = "state=", "change=", "merged="
_CLAIM = "_claim-"
KEPT = 8
# Changes that are put together, and the share of the table's rows at which they go into it.
MERGE_AFTER = 16
FOLD_AT = 0.25


class TrackingStore:
    """States of one tracking table below ``path``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = StructType(TRACKING.fields + POSITION.fields)

    def _numbers(self, kind: str = _STATE) -> list[int]:
        return [
            int(name[len(kind):]) for name in storage.folder_names(self.spark, self.path)
            if name.startswith(kind)
        ]

    def _folder(self, number: int, kind: str = _STATE) -> str:
        return f"{self.path}/{kind}{number:08d}"

    def _valid(self, number: int, kind: str = _STATE) -> bool:
        return storage.exists(self.spark, f"{self._folder(number, kind)}/_SUCCESS")

    def current(self) -> int | None:
        """Number of the newest complete state."""
        for number in sorted(self._numbers(), reverse=True):
            if self._valid(number):
                return number
        return None

    def changes(self) -> list[str]:
        """Folders of the outcomes since the current state: the newest merged ones and the changes after them."""
        after = self.current() or 0
        merged = [n for n in self._numbers(_MERGED) if n > after and self._valid(n, _MERGED)]
        last = max(merged, default=after)
        single = sorted(n for n in self._numbers(_CHANGE) if n > last and self._valid(n, _CHANGE))
        return [self._folder(last, _MERGED)] * bool(merged) + [self._folder(n, _CHANGE) for n in single]

    def _outcomes(self, folders: list[str]) -> DataFrame:
        """The newest outcome of each model. All folders hold the same columns."""
        return newest(reduce(DataFrame.unionByName, [self.spark.read.parquet(f) for f in folders]))

    def create(self) -> None:
        """An empty table, unless there is one."""
        if self.current() is None:
            self.write(self.spark.createDataFrame([], self.schema))

    def read_with_position(self) -> DataFrame:
        number = self.current()
        if number is None:
            raise FileNotFoundError(f"no tracking table at {self.path}")
        state, folders = self.spark.read.schema(self.schema).parquet(self._folder(number)), self.changes()
        return apply_latest(state, self._outcomes(folders)) if folders else state

    def read(self) -> DataFrame:
        """The 31 columns of the current state."""
        return self.read_with_position().select(*TRACKING.fieldNames())

    def write(self, state: DataFrame) -> None:
        """Commit the next state. Columns that are absent become NULL."""
        columns = [
            (F.col(f.name) if f.name in state.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema
        ]
        state.select(*columns).write.mode("errorifexists").parquet(self._folder(self._claimed()))
        self._forget()

    def _claimed(self) -> int:
        """A new number. An unfinished attempt keeps its own."""
        names = storage.names(self.spark, self.path) or []
        taken = [int(n.removeprefix(_CLAIM)) for n in names if n.startswith(_CLAIM)]
        number = max([*self._numbers(), *taken], default=0) + 1
        storage.claim(self.spark, f"{self.path}/{_CLAIM}{number:08d}")
        return number

    def append(self, outcomes: DataFrame) -> None:
        """Log outcomes (keys, any target columns, position); the table is not read or written.

        Outcomes of unknown models have no effect, and of one model the last by position counts, in
        whatever order they are logged.
        """
        if self.current() is None:
            raise FileNotFoundError(f"no tracking table at {self.path}")
        folders = self.changes()
        if folders and set(self.spark.read.parquet(folders[-1]).columns) != set(outcomes.columns):
            # Other columns than before: those logged so far go into the table first.
            self.update(lambda state: state)
            folders = []
        outcomes.write.mode("errorifexists").parquet(self._folder(self._claimed(), _CHANGE))
        if len(folders) >= MERGE_AFTER:
            self._merge()

    def _merge(self) -> None:
        """Put the logged outcomes together, or into the table when they are a share of it."""
        merged = self._outcomes(self.changes())
        number = self._claimed()
        merged.write.mode("errorifexists").parquet(self._folder(number, _MERGED))
        base = self.spark.read.schema(self.schema).parquet(self._folder(self.current()))
        if self.spark.read.parquet(self._folder(number, _MERGED)).count() >= FOLD_AT * base.count():
            self.update(lambda state: state)
        # The changes of the merge before this one have no readers any more.
        for old in sorted(n for n in self._numbers(_MERGED) if n < number)[-1:]:
            self._drop(lambda n: n <= old)

    def _drop(self, old: Callable[[int], bool]) -> None:
        for kind in (_CHANGE, _MERGED):
            for number in self._numbers(kind):
                if old(number):
                    storage.remove(self.spark, self._folder(number, kind))
                    storage.remove(self.spark, f"{self.path}/{_CLAIM}{number:08d}")

    def _forget(self) -> None:
        """Drop states, finished or not, that are older than the ``KEPT`` newest finished ones."""
        done = [
            n for n in sorted(self._numbers(), reverse=True)
            if storage.exists(self.spark, f"{self._folder(n)}/_SUCCESS")
        ]
        if len(done) > KEPT:
            for number in self._numbers():
                if number < done[KEPT - 1]:
                    storage.remove(self.spark, self._folder(number))
                    storage.remove(self.spark, f"{self.path}/{_CLAIM}{number:08d}")
            self._drop(lambda n: n < done[KEPT - 1])

    def update(self, change: Callable[[DataFrame], DataFrame]) -> None:
        """Commit ``change`` of the current state, positions included."""
        self.write(change(self.read_with_position()))


def merge_statement(table: str, staged: str) -> str:
    """The same upsert as MERGE, for tables whose format supports it."""
    on = " AND ".join(f"t.{k} = s.{k}" for k in TRACKING_KEYS)
    updates = ", ".join(f"t.{c} = s.{c}" for c in (*SOURCE_COLUMNS, "last_updated_at"))
    return (
        f"MERGE INTO {table} AS t USING {staged} AS s ON {on} "
        f"WHEN MATCHED THEN UPDATE SET {updates} WHEN NOT MATCHED THEN INSERT *"
    )

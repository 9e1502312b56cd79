"""Surrogate keys that stay the same from load to load.

A key book holds every business key that was ever numbered, with its surrogate
key. A load looks its rows up there and numbers only what is new, above the
largest number given so far. Entries are only ever added: a member that
disappears and comes back gets its old key, and extracts of earlier loads can
still be joined.

On disk a book is a set of folders of entries. Its last commit row names the
folders that count, so an application that dies while it adds entries changes
nothing. Commits are numbered; one application writes a book at a time.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakemart.operators.keys import add_dense_key
from lakemart.sources.files import children, delete, scratch_space

COMMITS = "number long, folders array<string>, entries long, largest long"


@dataclass(frozen=True)
class KeyBook:
    """Entries (``business`` columns, ``copy``, ``name``) below ``path``.

    ``copy`` counts rows that share one business key from 0 on, so that each has
    a key of its own. ``business`` names columns with their types.
    """

    spark: SparkSession
    path: str
    name: str
    business: str
    fold_after: int = 16

    @property
    def schema(self) -> T.StructType:
        fields = T._parse_datatype_string(self.business).fields
        return T.StructType([*fields, T.StructField("copy", T.IntegerType()), T.StructField(self.name, T.LongType())])

    @property
    def columns(self) -> list[str]:
        return [*T._parse_datatype_string(self.business).names, "copy"]

    def _last_commit(self) -> tuple[int, list[str], int, int]:
        """Number of the last commit, its folders, entries and the largest key."""
        try:
            commits = self.spark.read.schema(COMMITS).parquet(f"{self.path}/_commits")
            last = commits.orderBy(F.desc("number")).first()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            last = None
        return (last["number"], list(last["folders"]), last["entries"], last["largest"]) if last else (0, [], 0, 0)

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in folders))

    def entries(self) -> DataFrame:
        return self._read(self._last_commit()[1])

    def enter(self, rows: DataFrame, *order: Column | str) -> int:
        """Number the business keys that the book does not know, in the given order; returns how many.

        Known keys are dropped by an anti-join before anything is numbered, so
        a load that brings nothing new numbers nothing. ``order`` may name any
        column of ``rows``; it decides numbers of new entries and, for rows
        that share a business key, which copy is which.
        """
        number, folders, known, largest = self._last_commit()
        with scratch_space(self.spark):
            fresh = self._matched(self._with_copy(rows, order), self._read(folders), "left_anti")
            numbered = add_dense_key(fresh, "_place", *order).select(
                *(F.col(c).cast(self.schema[c].dataType).alias(c) for c in self.columns), (F.col("_place") + largest).alias(self.name)
            )
            folder = uuid.uuid4().hex
            numbered.write.parquet(f"{self.path}/{folder}")
        added, highest = self._read([folder]).agg(F.count("*"), F.coalesce(F.max(self.name), F.lit(largest))).first()
        if added:
            self._commit(number + 1, [*folders, folder], known + added, highest)
            if len(folders) >= self.fold_after:
                self._fold()
        else:
            delete(self.spark, f"{self.path}/{folder}")
        return added

    def look_up(self, rows: DataFrame, *order: Column | str) -> DataFrame:
        """``rows`` with their key, as the first column. All must have been entered."""
        found = self._matched(self._with_copy(rows, order), self.entries().withColumnRenamed(self.name, "_key"), "left")
        missing = F.raise_error(F.lit(f"{self.name}: a row was not entered into the book")).cast("long")
        return found.select(F.coalesce("_key", missing).alias(self.name), *rows.columns)

    def keyed(self, rows: DataFrame, *order: Column | str) -> DataFrame:
        """Enter what is new, then look everything up."""
        self.enter(rows, *order)
        return self.look_up(rows, *order)

    def _with_copy(self, rows: DataFrame, order: tuple[Column | str, ...]) -> DataFrame:
        same = Window.partitionBy(*self.columns[:-1]).orderBy(*order)
        return rows.withColumn("copy", F.row_number().over(same) - 1)

    def _matched(self, rows: DataFrame, entries: DataFrame, how: str) -> DataFrame:
        """Joined by business key and copy; a NULL matches a NULL."""
        named = entries.withColumnsRenamed({c: f"_of_{c}" for c in self.columns})
        return rows.join(named, reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in self.columns)), how)

    def _commit(self, number: int, folders: list[str], entries: int, largest: int) -> None:
        row = self.spark.createDataFrame([(number, folders, entries, largest)], COMMITS)
        row.coalesce(1).write.mode("append").parquet(f"{self.path}/_commits")

    def _fold(self) -> None:
        """Write many small folders as one; the old ones stay until ``reclaim``, as they may still be read."""
        number, folders, entries, largest = self._last_commit()
        folder = uuid.uuid4().hex
        self._read(folders).write.parquet(f"{self.path}/{folder}")
        self._commit(number + 1, [folder], entries, largest)

    def reclaim(self) -> list[str]:
        """Remove folders that the last commit doesn't name. Not to be run while the book is written or an old state is read."""
        current = {"_commits", *self._last_commit()[1]}
        gone = [name for name in children(self.spark, self.path) if name not in current]
        for name in gone:
            delete(self.spark, f"{self.path}/{name}")
        return gone

"""Versioned layer tables on any file system Spark writes to.

Every load writes its tables to new folders and then appends its audit rows. The
row that says ``loaded`` is the commit: readers take the latest load that has
one, so a load that fails half-way, or whose driver dies, changes nothing.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from lakemart.operators.checks import KeyRule, RowRule, Rule, violations
from lakemart.operators.measures import stack
from lakemart.sources import buckets
from lakemart.sources.buckets import Refresh, Upsert
from lakemart.sources.contracts import SAME, VERSIONS, WIDEN, Contract, ContractBroken
from lakemart.sources.files import children, delete, scratch_space

AUDIT = T.StructType([
    T.StructField("load_id", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),  # NULL on the row of the whole load
    T.StructField("rows", T.LongType()),
    T.StructField("started_at", T.TimestampType()),
    T.StructField("seconds", T.DecimalType(12, 2)),
    T.StructField("status", T.StringType()),  # written, loaded, failed
    T.StructField("message", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),  # of a row that says loaded: the commit
])


FINDINGS = T.StructType([
    T.StructField("load_id", T.StringType()),
    T.StructField("layer", T.StringType()),
    T.StructField("table_name", T.StringType()),
    T.StructField("check_name", T.StringType()),
    T.StructField("violations", T.LongType()),
    T.StructField("passed", T.BooleanType()),
])


class RulesBroken(ValueError):
    """A load was refused: what it wrote broke rules."""

    def __init__(self, layer: str, found: Mapping[str, Mapping[str, int]]):
        self.found = {table: {name: n for name, n in counts.items() if n} for table, counts in found.items() if any(counts.values())}
        told = "; ".join(f"{table}: " + ", ".join(f"{name} {n}" for name, n in counts.items()) for table, counts in self.found.items())
        super().__init__(f"{layer} breaks its rules ({told})")


Table = DataFrame | Refresh | Upsert | Callable[[Mapping[str, DataFrame]], DataFrame | Refresh | Upsert]


@dataclass(frozen=True)
class LayerStore:
    """Tables below ``base``, one folder per layer, table and load."""

    spark: SparkSession
    base: str

    def _audit_path(self) -> str:
        return f"{self.base.rstrip('/')}/_loads"

    def path(self, layer: str, table: str, load_id: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}/{table}/{load_id}"

    def audit(self) -> DataFrame:
        """Every table and load ever attempted, with rows, seconds and outcome."""
        try:
            return self.spark.read.schema(AUDIT).parquet(self._audit_path())
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], AUDIT)

    def current_load(self, layer: str) -> str:
        done = self.audit().filter(
            (F.col("layer") == layer) & F.col("table_name").isNull() & (F.col("status") == "loaded")
        )
        latest = done.agg(F.max_by("load_id", F.struct("logged_at", "load_id"))).first()[0]
        if latest is None:
            raise LookupError(f"layer {layer} was never loaded")
        return latest

    def read(self, layer: str, table: str, load_id: str | None = None) -> DataFrame:
        path = self.path(layer, table, load_id or self.current_load(layer))
        if buckets.is_bucketed(self.spark, path):
            schema = buckets.stored_schema(self.spark, path)
            return buckets.read(self.spark, path.rsplit("/", 1)[0], buckets.manifest(self.spark, path), schema)
        return self.spark.read.parquet(path)

    def _current_buckets(self, layer: str, table: str) -> dict[str, buckets.Bucket]:
        """What the current load of a bucketed table consists of; nothing if there is none."""
        try:
            path = self.path(layer, table, self.current_load(layer))
        except LookupError:
            return {}
        return buckets.manifest(self.spark, path) if buckets.is_bucketed(self.spark, path) else {}

    def read_all(self, layer: str, tables: tuple[str, ...]) -> dict[str, DataFrame]:
        load_id = self.current_load(layer)
        return {table: self.read(layer, table, load_id) for table in tables}

    def load(
        self, layer: str, tables: Mapping[str, Table], rules: Mapping[str, Sequence[Rule]] | None = None, on_broken: str = "refuse",
        contracts: Mapping[str, str] | None = None,
    ) -> str:
        """Write all tables of a layer, or none: an error is recorded and raised again.

        A table that builds on others of the same load is given as a function of
        the tables written so far, which it reads back instead of computing them
        again. Rows are counted while they are written (Observation), not in a
        second pass. Of a table given as ``Refresh`` or ``Upsert`` only the
        buckets that change are written.

        ``rules`` of rows are observed in that pass, too, and keys are checked on
        what was written, reading the key only. All findings are recorded. If a
        rule is broken the load is not committed and ``RulesBroken`` is raised,
        unless ``on_broken`` is ``record``. Of bucketed tables the rows written
        are checked; the others were when they were.

        ``contracts`` put tables under a contract from this load on: ``widen``
        lets later loads add columns and widen types, ``same`` nothing. A table
        under contract stays so; a load that breaks it raises ``ContractBroken``
        before the table is written.
        """
        if on_broken not in ("refuse", "record"):
            raise ValueError(f"on_broken must be refuse or record, not {on_broken}")
        if wrong := set((contracts or {}).values()) - {WIDEN, SAME}:
            raise ValueError(f"a contract allows {WIDEN} or {SAME}, not {', '.join(sorted(wrong))}")
        load_id = f"{dt.datetime.now(dt.UTC):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
        began, clock = dt.datetime.now(dt.UTC), time.monotonic()
        log, total, table = [], 0, None
        written: dict[str, DataFrame] = {}
        found: dict[str, dict[str, int]] = {}
        promised: dict[str, Contract] = {}
        try:
            under = self._contracts(layer)
            for table, rows_or_plan in tables.items():
                table_began, table_clock = dt.datetime.now(dt.UTC), time.monotonic()
                path, message, own = self.path(layer, table, load_id), None, list((rules or {}).get(table, ()))
                with scratch_space(self.spark):
                    df = rows_or_plan(written) if callable(rows_or_plan) else rows_or_plan
                    allows = (contracts or {}).get(table)
                    if allows or table in under:
                        columns = df.rows.schema if isinstance(df, Refresh | Upsert) else df.schema
                        promised[table] = _kept(layer, table, under.get(table), allows, columns)
                    watch = _Watch(own)
                    if isinstance(df, Refresh | Upsert):
                        rows, some, all_ = buckets.write(self.spark, path.rsplit("/", 1)[0], load_id, df, self._current_buckets(layer, table), watch.over)
                        message = f"{some} of {all_} buckets written"
                    else:
                        watch.over(df).write.parquet(path)
                        rows = watch.counts()["rows"]
                written[table] = self.read(layer, table, load_id) if message else self.spark.read.schema(df.schema).parquet(path)
                if own:
                    found[table] = watch.broken() | {
                        r.name: violations(written[table].select(r.key), r).count() for r in own if isinstance(r, KeyRule)
                    }
                total += rows
                log.append((load_id, layer, table, rows, table_began, _since(table_clock), "written", message))
            table = None
            self._record(load_id, layer, found)
            self._promise(load_id, layer, {t: c for t, c in promised.items() if c != under.get(t)})
            if on_broken == "refuse" and any(n for counts in found.values() for n in counts.values()):
                raise RulesBroken(layer, found)
        except Exception as error:
            log.append((load_id, layer, table, None, began, _since(clock), "failed", str(error)))
            self._append(log)
            raise
        log.append((load_id, layer, None, total, began, _since(clock), "loaded", None))
        self._append(log)
        return load_id

    def _record(self, load_id: str, layer: str, found: Mapping[str, Mapping[str, int]]) -> None:
        rows = [(load_id, layer, table, name, n, n == 0) for table, counts in found.items() for name, n in counts.items()]
        if rows:
            self.spark.createDataFrame(rows, FINDINGS).coalesce(1).write.mode("append").parquet(f"{self.base.rstrip('/')}/_findings")

    def _versions(self, layer: str) -> DataFrame:
        """Versions of the contracts of a layer that committed loads have made."""
        path = "_contracts"
        if path not in children(self.spark, self.base):
            return self.spark.createDataFrame([], VERSIONS)
        made = self.spark.read.schema(VERSIONS).parquet(f"{self.base.rstrip('/')}/{path}").filter(F.col("layer") == layer)
        return made.join(self._committed(layer).select("load_id"), "load_id", "left_semi")

    def _committed(self, layer: str) -> DataFrame:
        return self.audit().filter((F.col("layer") == layer) & F.col("table_name").isNull() & (F.col("status") == "loaded"))

    def _contracts(self, layer: str) -> dict[str, Contract]:
        """The current contract of every table that has one; one row per table and version is read."""
        rows = sorted(self._versions(layer).collect(), key=lambda r: (r["version"], r["load_id"]))
        return {r["table_name"]: Contract(r["version"], r["allows"], T.StructType.fromJson(json.loads(r["schema"]))) for r in rows}

    def _promise(self, load_id: str, layer: str, promised: Mapping[str, Contract]) -> None:
        rows = [(layer, table, c.version, load_id, c.allows, c.schema.json()) for table, c in promised.items()]
        if rows:
            self.spark.createDataFrame(rows, VERSIONS).coalesce(1).write.mode("append").parquet(f"{self.base.rstrip('/')}/_contracts")

    def contract(self, layer: str, table: str) -> Contract | None:
        """What a table promises at present; None for a table without contract."""
        return self._contracts(layer).get(table)

    def read_loads(self, layer: str, table: str) -> DataFrame:
        """The rows of every committed load of a table that is still there, by the current contract, with their ``load_id``.

        Loads of before the contract have to fit it. Whole tables are read in one scan; bucketed ones load by load.
        """
        contract = self.contract(layer, table)
        if contract is None:
            raise LookupError(f"{layer}.{table} has no contract")
        base = f"{self.base.rstrip('/')}/{layer}/{table}"
        there = set(children(self.spark, base))
        loads = sorted(r["load_id"] for r in self._committed(layer).select("load_id").collect() if r["load_id"] in there)
        bucketed = [i for i in loads if buckets.is_bucketed(self.spark, f"{base}/{i}")]
        whole = [f"{base}/{i}" for i in loads if i not in bucketed]
        parts = [
            buckets.read(self.spark, base, buckets.manifest(self.spark, f"{base}/{i}"), contract.schema).withColumn("load_id", F.lit(i))
            for i in bucketed
        ]
        if whole:
            of = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
            parts.append(self.spark.read.schema(contract.schema).parquet(*whole).withColumn("load_id", of))
        return stack(*parts)

    def findings(self, layer: str) -> DataFrame:
        """What the rules of every load of a layer found, of refused loads, too."""
        try:
            return self.spark.read.schema(FINDINGS).parquet(f"{self.base.rstrip('/')}/_findings").filter(F.col("layer") == layer)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], FINDINGS)

    def _append(self, log: list[tuple]) -> None:
        now = dt.datetime.now(dt.UTC)
        self.spark.createDataFrame([(*row, now) for row in log], AUDIT).coalesce(1).write.mode("append").parquet(self._audit_path())

    def row_counts(self, layer: str) -> DataFrame:
        """Rows per table of the current load, from the audit; no table is read again."""
        load_id = self.current_load(layer)
        return self.audit().filter(
            (F.col("load_id") == load_id) & F.col("table_name").isNotNull()
        ).select("layer", "table_name", "rows")

    def register(self, layer: str, tables: tuple[str, ...]) -> None:
        """Make the current load readable as ``layer.table`` in the catalog.

        Each is a view over the files of the load, replaced in one statement:
        readers see the old load or the new one.
        """
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {layer}")
        load_id = self.current_load(layer)
        for table in tables:
            path = self.path(layer, table, load_id)
            rows = f"SELECT * FROM parquet.`{path}`"
            if buckets.is_bucketed(self.spark, path):
                columns = buckets.stored_schema(self.spark, path).names
                rows = buckets.as_sql(path.rsplit("/", 1)[0], load_id, buckets.manifest(self.spark, path), columns)
            self.spark.sql(f"CREATE OR REPLACE VIEW {layer}.{table} AS {rows}")

    def reclaim(self, layer: str, keep: int = 1) -> list[str]:
        """Remove the files of all loads of a layer but the last ``keep`` committed ones; returns what went.

        The audit stays. Not to be run while a load of the layer is going on or
        a replaced load is still being read.
        """
        committed = self.audit().filter(
            (F.col("layer") == layer) & F.col("table_name").isNull() & (F.col("status") == "loaded")
        )
        stay = {r["load_id"] for r in committed.orderBy(F.desc("logged_at"), F.desc("load_id")).limit(keep).collect()}
        gone = []
        base = f"{self.base.rstrip('/')}/{layer}"
        for table in children(self.spark, base):
            needed = self._buckets_in_use(layer, table, stay)
            for load_id in children(self.spark, f"{base}/{table}"):
                if load_id in stay:
                    continue
                if load_id not in needed:
                    delete(self.spark, f"{base}/{table}/{load_id}")
                    gone.append(f"{table}/{load_id}")
                    continue
                for folder in children(self.spark, f"{base}/{table}/{load_id}"):
                    if folder.startswith(f"{buckets.FOLDER}=") and folder.split("=", 1)[1] not in needed[load_id]:
                        delete(self.spark, f"{base}/{table}/{load_id}/{folder}")
                        gone.append(f"{table}/{load_id}/{folder}")
        return gone

    def _buckets_in_use(self, layer: str, table: str, loads: set[str]) -> dict[str, set[str]]:
        """Loads and buckets that the manifests of some loads name."""
        needed: dict[str, set[str]] = {}
        for load_id in loads:
            path = self.path(layer, table, load_id)
            if buckets.is_bucketed(self.spark, path):
                for label, bucket in buckets.manifest(self.spark, path).items():
                    needed.setdefault(bucket.load_id, set()).add(label)
        return needed


class _Watch:
    """Counts rows, and rows that break rules, while they are written."""

    def __init__(self, rules: Sequence[Rule]):
        self._rules = [r for r in rules if isinstance(r, RowRule)]
        self._seen: Observation | None = None

    def over(self, df: DataFrame) -> DataFrame:
        self._seen = Observation()
        broken = [F.count_if(r.bad).alias(f"rule_{i}") for i, r in enumerate(self._rules)]
        return df.observe(self._seen, F.count(F.lit(1)).alias("rows"), *broken)

    def counts(self) -> dict[str, int]:
        """Of what was written; nothing was if nobody watched."""
        return self._seen.get if self._seen else {"rows": 0}

    def broken(self) -> dict[str, int]:
        counts = self.counts()
        return {r.name: counts.get(f"rule_{i}", 0) for i, r in enumerate(self._rules)}


def _kept(layer: str, table: str, contract: Contract | None, allows: str | None, columns: T.StructType) -> Contract:
    """The contract after a load with these columns."""
    if contract is None:
        return Contract(1, allows, columns)
    if breaks := contract.breaks(columns):
        raise ContractBroken(layer, table, contract.version, breaks)
    following = contract.following(columns)
    return Contract(following.version, allows or contract.allows, following.schema)


def _since(clock: float) -> Decimal:
    return Decimal(str(round(time.monotonic() - clock, 2)))


def export(df: DataFrame, target_format: str, path: str | None = None, **options: str) -> None:
    """Hand a table to other tools: parquet, csv, json, orc, or jdbc by its options."""
    writer = df.write.format(target_format).mode("overwrite").options(**options)
    writer.save(path) if path else writer.save()

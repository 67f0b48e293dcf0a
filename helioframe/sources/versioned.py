"""Stored tables that change in one step: immutable data folders, and a version file that names the live ones.

Every write puts its rows into a folder of its own, ``data/write__=<id>``, partitioned by day and, where the table has
them, by hash buckets of the key. Nothing is overwritten. The write is published by creating the next file in
``_versions``, which lists the live folders and the columns; readers open the newest one. A job or a driver that
dies anywhere before that leaves the old table, and two writers cannot publish the same version: the second is refused.

A keyed write replaces only the buckets that hold a key which comes with other values. A column that is added or
removed changes the version file alone: files are read with the declared columns, so a column they lack is NULL. Column
names are kept apart from the names in the files, so a column that goes and comes back does not show its old values.

Folders that no version names any more are removed by ``vacuum``, after a time in which running readers end.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from helioframe.functions.clock import DAY
from helioframe.operators.incremental import check_schema
from helioframe.sources.files import child_files, child_folders, delete_path, discard, materialize, read_text, write_new

WRITE, BUCKET = "write__", "bucket__"
_NULL_DAY = "__HIVE_DEFAULT_PARTITION__"


def changed_rows(batch: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Batch rows that the table does not hold in the very same form; only keys and a hash are shuffled."""
    # The hash of a row passes over NULLs, so where they stand is hashed with it.
    row = F.xxhash64(*batch.columns, F.array(*(F.col(c).isNull() for c in batch.columns)))
    held = stored.select(*(F.col(k).alias(f"__held_{k}") for k in keys), row.alias("__held_row"))
    same = [F.col(k).eqNullSafe(F.col(f"__held_{k}")) for k in keys] + [F.col("__row") == F.col("__held_row")]
    return batch.withColumn("__row", row).join(held, reduce(Column.__and__, same), "left_anti").drop("__row")


class Table:
    """A table under ``path``; its layout is fixed by the first write.

    ``partition`` is a column the rows bring (None for a table without), ``bucket_by`` the key whose hash deals the
    rows of a partition into ``buckets`` folders (0 for none).
    """

    def __init__(
        self, spark: SparkSession, path: str, partition: str | None = DAY, bucket_by: Sequence[str] = (), buckets: int = 0
    ):
        self.spark, self.root = spark, path.rstrip("/")
        self._partition, self._bucket_by, self._buckets = partition, list(bucket_by), buckets if bucket_by else 0

    # Versions

    @staticmethod
    def is_at(spark: SparkSession, path: str) -> bool:
        return bool(_versions(spark, path.rstrip("/")))

    def exists(self) -> bool:
        return self.is_at(self.spark, self.root)

    def version(self) -> int:
        return max(_versions(self.spark, self.root), default=0)

    def _state(self) -> dict:
        newest = self.version()
        if newest:
            return json.loads(read_text(self.spark, _version_path(self.root, newest))) | {"version": newest}
        layout = {"partition": self._partition, "bucket_by": self._bucket_by, "buckets": self._buckets}
        return {"version": 0, **layout, "columns": [], "retired": [], "writes": {}}

    def _publish(self, state: dict) -> None:
        said = {k: v for k, v in state.items() if k != "version"} | {"at": time.time()}
        write_new(self.spark, _version_path(self.root, state["version"] + 1), json.dumps(said))

    # Reading

    def schema(self) -> T.StructType:
        return _schema(self._state())

    def read(self) -> DataFrame:
        """All live rows; bounds on the partition column prune folders."""
        return self._rows(self._state())

    def leaves(self) -> list[tuple[str, str]]:
        """Live folders as (write, partition and bucket)."""
        return [(write, leaf) for write, held in self._state()["writes"].items() for leaf in held["live"]]

    def partitions(self) -> list[str]:
        """Values of the partition column that have live folders."""
        return sorted({_value(leaf) for _, leaf in self.leaves()})

    def _rows(self, state: dict, only: Callable[[str], bool] | None = None, bucketed: bool = False) -> DataFrame:
        schema, partition, paths = _schema(state), state["partition"], []
        for write, held in state["writes"].items():
            live = [leaf for leaf in held["live"] if only is None or only(leaf)]
            # A write that is live as a whole is one path, whatever its number of folders.
            whole = held["whole"] and len(live) == len(held["live"])
            paths += [f"{self.root}/data/{WRITE}={write}" + ("" if whole or not leaf else f"/{leaf}") for leaf in (live[:1] if whole else live)]
        if not paths:
            nothing = self.spark.createDataFrame([], schema)
            return nothing.withColumn(BUCKET, F.lit(None).cast("int")) if bucketed else nothing
        stored = T.StructType([T.StructField(c["stored"], _type(c["type"])) for c in state["columns"] if c["name"] != partition])
        stored = stored.add(WRITE, T.StringType())
        if partition:
            stored = stored.add(partition, schema[partition].dataType)
        if state["buckets"]:
            stored = stored.add(BUCKET, T.IntegerType())
        rows = self.spark.read.schema(stored).option("basePath", f"{self.root}/data").parquet(*paths)
        names = [F.col(c["stored"]).alias(c["name"]) if c["name"] != partition else F.col(partition) for c in state["columns"]]
        return rows.select(*names, *([BUCKET] if bucketed else []))

    # Writing

    def create(self, df: DataFrame) -> None:
        """Full refresh; ``df`` may read this table."""
        state = self._state()
        state["columns"] = _columns(df.schema, state)
        state["writes"] = self._put(df, state)
        self._publish(state)

    def append(self, batch: DataFrame) -> None:
        """Add rows; a batch whose columns differ from the table's is refused."""
        if not self.exists():
            return self.create(batch)
        state = self._state()
        check_schema(batch, _rows_like(self.spark, state))
        state["writes"] |= self._put(batch, state)
        self._publish(state)

    def replace(self, batch: DataFrame, gone: Callable[[str], bool] | None = None) -> None:
        """Replace every partition that occurs in the batch, and those whose value ``gone`` names, in one step."""
        if not self.exists():
            return self.create(batch)
        state = self._state()
        check_schema(batch, _rows_like(self.spark, state))
        put = self._put(batch, state)
        named = {_value(leaf) for held in put.values() for leaf in held["live"]}
        _without(state, lambda leaf: _value(leaf) in named or (gone is not None and gone(_value(leaf))))
        state["writes"] |= put
        self._publish(state)

    def drop_partitions(self, values: Iterable[str]) -> None:
        state, values = self._state(), set(values)
        if values:
            _without(state, lambda leaf: _value(leaf) in values)
            self._publish(state)

    def compact(self, values: Iterable[str]) -> None:
        """The rows of these partitions in one clustered write."""
        state, values = self._state(), set(values)
        if values:
            inside = lambda leaf: _value(leaf) in values
            put = self._put(self._rows(state, inside), state)
            _without(state, inside)
            state["writes"] |= put
            self._publish(state)

    def evolve(self, schema: T.StructType) -> None:
        """Take these columns from now on: new ones are NULL in stored rows, others go. No data file is touched."""
        state = self._state()
        columns = _columns(schema, state)
        if columns != state["columns"]:
            kept = {c["stored"] for c in columns}
            state["retired"] = sorted({*state["retired"], *(c["stored"] for c in state["columns"] if c["stored"] not in kept)})
            state["columns"] = columns
            self._publish(state)

    def upsert(
        self, batch: DataFrame, keys: Sequence[str], on_schema_change: str = "fail", on_change: Callable[[DataFrame], None] | None = None
    ) -> list:
        """Put in a batch with unique keys; its rows replace rows of the same key.

        Rows stored already in the same form are left out first, so a batch delivered again writes nothing. Of the
        folders the batch names, those that hold a key with other values are written anew without it, in the same
        write that brings the batch's rows. ``on_change`` is given the rows that will be written, before they are.
        Returns the partition values the batch names.
        """
        if not self.exists():
            if on_change:
                on_change(batch)
            self.create(batch)
            return sorted((row[0] for row in self.read().select(self._state()["partition"]).distinct().collect()), key=str)
        if on_schema_change == "sync":
            self.evolve(batch.schema)
        state = self._state()
        check_schema(batch, _rows_like(self.spark, state))
        partition, columns = state["partition"], batch.columns
        match = list(dict.fromkeys([*keys, *([partition] if partition else [])]))
        ready, changed = materialize(self.spark, batch), None
        try:
            place = [*([F.col(partition)] if partition else []), *([_bucket(state).alias(BUCKET)] if state["buckets"] else [])]
            named = ready.select(*place).distinct().collect() if place else [()]  # one row a folder
            leaves = {_leaf(state, row) for row in named}
            if not named:
                return []
            stored = self._rows(state, lambda leaf: leaf in leaves, bucketed=bool(state["buckets"]))
            changed = materialize(self.spark, changed_rows(ready, stored.select(*columns), match))
            if on_change:
                on_change(changed)
            here = [c for c in (partition, BUCKET if state["buckets"] else None) if c]
            same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"__new_{k}")) for k in match])
            new = changed.select(*(F.col(k).alias(f"__new_{k}") for k in match))
            clashing = stored.join(new, same, "left_semi")
            clashing = {_leaf(state, row) for row in clashing.select(*here).distinct().collect()} if here else ({""} if clashing.limit(1).count() else set())
            rows = changed
            if clashing:
                kept = self._rows(state, lambda leaf: leaf in clashing).select(*columns)
                rows = changed.unionByName(kept.join(new, same, "left_anti"))
            if rows is not changed or changed.limit(1).count():
                put = self._put(rows, state)
                _without(state, lambda leaf: leaf in clashing)
                state["writes"] |= put
                self._publish(state)
            return sorted({row[0] for row in named}, key=str) if partition else []
        finally:
            discard(self.spark, ready)
            if changed is not None:
                discard(self.spark, changed)

    def vacuum(self, older_than_s: float = 86400.0) -> list[str]:
        """Remove version files older than that but the newest, then the folders that no version names.

        A folder younger than that may belong to a write that is not published yet and stays too.
        """
        newest, border = self.version(), time.time() - older_than_s
        kept: set[str] = set()
        for number in _versions(self.spark, self.root):
            said = json.loads(read_text(self.spark, _version_path(self.root, number)))
            if number != newest and said["at"] < border:
                delete_path(self.spark, _version_path(self.root, number))
            else:
                kept |= {f"{write}/{leaf}" for write, held in said["writes"].items() for leaf in held["live"]}
        writes = {name.rsplit("/", 1)[0] if "/" in name else name for name in kept}
        removed = []
        for folder in child_folders(self.spark, f"{self.root}/data"):
            write = folder.split("=", 1)[1]
            if float(write.split("-")[0]) / 1000 >= border:
                continue
            if not any(w == write or w.startswith(f"{write}/") for w in writes):
                removed.append(folder)
                delete_path(self.spark, f"{self.root}/data/{folder}")
            else:
                dead = [leaf for leaf in _leaves(self.spark, f"{self.root}/data/{folder}") if f"{write}/{leaf}" not in kept]
                removed += [f"{folder}/{leaf}" for leaf in dead]
                for leaf in dead:
                    delete_path(self.spark, f"{self.root}/data/{folder}/{leaf}")
        return removed

    def _put(self, df: DataFrame, state: dict) -> dict:
        """Write rows into a folder of their own; the entry that names its folders, none for no rows."""
        write = f"{int(time.time() * 1000)}-{uuid.uuid4().hex}"
        names = {c["name"]: c["stored"] for c in state["columns"]}
        rows, partition = df, state["partition"]
        if state["buckets"]:
            rows = rows.withColumn(BUCKET, _bucket(state))
        place = [c for c in (partition, BUCKET if state["buckets"] else None) if c]
        # REBALANCE cuts a large folder into several files of the advisory size and merges small ones.
        rows = rows.hint("rebalance", *place) if place else rows.hint("rebalance")
        order = [F.col(c) for c in place] + [F.col(c) for c in ("device_id",) if c in names] + [F.desc(c) for c in ("timestamp",) if c in names]
        rows = rows.sortWithinPartitions(*order) if order else rows
        rows = rows.select(*(F.col(c).alias(names[c]) for c in df.columns if c != partition), *place)
        writer = rows.write.mode("error")
        (writer.partitionBy(*place) if place else writer).parquet(f"{self.root}/data/{WRITE}={write}")
        live = _leaves(self.spark, f"{self.root}/data/{WRITE}={write}") if place else [""]
        return {write: {"live": live, "whole": True}} if live else {}


def _versions(spark: SparkSession, root: str) -> list[int]:
    return [int(name[: -len(".json")]) for name in child_files(spark, f"{root}/_versions") if name.endswith(".json") and name[0] != "."]


def _version_path(root: str, number: int) -> str:
    return f"{root}/_versions/{number:012d}.json"


def _type(said) -> T.DataType:
    return T.StructField.fromJson({"name": "", "type": said, "nullable": True, "metadata": {}}).dataType


def _schema(state: dict) -> T.StructType:
    return T.StructType([T.StructField(c["name"], _type(c["type"])) for c in state["columns"]])


def _rows_like(spark: SparkSession, state: dict) -> DataFrame:
    return spark.createDataFrame([], _schema(state))


def _columns(schema: T.StructType, state: dict) -> list[dict]:
    """The columns with their names in the files; a name that another type or a removed column had gets a new one."""
    known = {c["name"]: c for c in state["columns"]}
    taken = {c["stored"] for c in state["columns"]} | set(state["retired"])
    out = []
    for field in schema:
        said = field.dataType.jsonValue()
        if field.name in known and known[field.name]["type"] == said:
            out.append(known[field.name])
            continue
        stored = field.name
        while stored in taken or stored in (WRITE, BUCKET):
            stored += "_"
        out.append({"name": field.name, "type": said, "stored": stored})
    return out


def _bucket(state: dict) -> Column:
    return F.pmod(F.xxhash64(*state["bucket_by"]), F.lit(state["buckets"])).cast("int")


def _leaf(state: dict, row: Sequence) -> str:
    """The folder of a partition value and a bucket."""
    parts, values = [], list(row)
    if state["partition"]:
        value = values.pop(0)
        parts.append(f"{state['partition']}={_NULL_DAY if value is None else value}")
    if state["buckets"]:
        parts.append(f"{BUCKET}={values.pop(0)}")
    return "/".join(parts)


def _value(leaf: str) -> str:
    return leaf.split("/")[0].split("=", 1)[1] if leaf else ""


def _leaves(spark: SparkSession, folder: str) -> list[str]:
    """Partition folders below a write, relative to it."""
    out = []
    for first in child_folders(spark, folder):
        if "=" in first:
            below = [second for second in child_folders(spark, f"{folder}/{first}") if "=" in second]
            out += [f"{first}/{second}" for second in below] or [first]
    return out


def _without(state: dict, dead: Callable[[str], bool]) -> None:
    """Take folders out of the live ones."""
    kept = {}
    for write, held in state["writes"].items():
        live = [leaf for leaf in held["live"] if not dead(leaf)]
        if live:
            kept[write] = {"live": live, "whole": held["whole"] and len(live) == len(held["live"])}
    state["writes"] = kept


def day_of(value: str) -> date | None:
    return None if value == _NULL_DAY else date.fromisoformat(value)

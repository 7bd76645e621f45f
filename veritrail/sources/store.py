"""A versioned store on Parquet: commits, reads by version and by time, history, upserts with change counts, replace by partition.

<root>/<table>/_commit=<n>/ holds the files that commit n wrote, by partition where the table has a partition column;
<root>/<table>/_log/ has a row for each commit, which lists the directories that its version consists of. So a commit writes what it
changes and names the rest. It writes its files first and its log row last, so that readers see whole versions. One
writer at a time: concurrent commits are not supported. Paths go through Spark's own readers and writers, so that the root
may be on any file system."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import differs
from ..operators.relational import latest
from ..session import cut, path_of

LOG = "version bigint, committed_at timestamp, operation string, rows bigint, added bigint, updated bigint, deleted bigint, partition_column string"
#: The name of the partition of nulls.
DEFAULT = "__HIVE_DEFAULT_PARTITION__"
PARTS = "written bigint, month_of string, schema string, parts array<string>"


@dataclass(frozen=True)
class Staged:
    """Files of a version that is not committed yet: their rows, and what was counted while they were written."""

    store: Store
    table: str
    row: tuple
    rows: DataFrame
    counts: dict

    def commit(self) -> int:
        n, _, *more = self.row
        log = self.store.spark.createDataFrame([(n, datetime.now(timezone.utc).replace(tzinfo=None), *more)], f"{LOG}, {PARTS}")
        log.coalesce(1).write.mode("append").parquet(self.store._log(self.table))
        return n


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _log(self, table: str) -> str:
        return f"{self.root}/{table}/_log"

    def exists(self, table: str) -> bool:
        path, fs = path_of(self.spark, self._log(table))
        return fs.exists(path)

    def refresh(self, table: str) -> None:
        """Makes the session forget what it knows of the table's files."""
        self.spark.catalog.refreshByPath(f"{self.root}/{table}")

    def _commits(self, table: str) -> DataFrame:
        if not self.exists(table):
            return self.spark.createDataFrame([], f"{LOG}, {PARTS}")
        return self.spark.read.schema(f"{LOG}, {PARTS}").parquet(self._log(table))

    def history(self, table: str) -> DataFrame:
        """A row for each commit, the last first; `written` is the number of rows that it wrote."""
        return self._commits(table).drop("month_of", "schema", "parts").orderBy(F.desc("version"))

    def version(self, table: str, at: datetime | None = None) -> int | None:
        """The last version, or the last one committed by a time (in UTC)."""
        rows = self._commits(table)
        if at is not None:
            rows = rows.where(F.col("committed_at") <= F.lit(at))
        return rows.agg(F.max("version")).first()[0]

    def _commit(self, table: str, version: int | None):
        found = self._commits(table).where(F.col("version") == F.lit(version)).first() if version is not None else None
        if found is None:
            raise FileNotFoundError(f"{table}: no such version ({version})")
        return found

    def _rows(self, table: str, commit, parts: Sequence[str]) -> DataFrame:
        """The rows of some of the directories of a version."""
        schema = StructType.fromJson(json.loads(commit["schema"]))
        if not parts:
            return self.spark.createDataFrame([], schema)
        base = f"{self.root}/{table}"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/{p}" for p in parts]).select(*[f"`{c}`" for c in schema.names])

    def read(self, table: str, version: int | None = None, at: datetime | None = None, where: Column | None = None) -> DataFrame:
        """A version of the table: the last, a named one, or that of a time. Fails where there is none.

        where: a condition; one on the partition column leaves out the directories that do not meet it."""
        commit = self._commit(table, version if version is not None else self.version(table, at))
        rows = self._rows(table, commit, commit["parts"])
        return rows.where(where) if where is not None else rows

    def read_or_empty(self, table: str, schema: str) -> DataFrame:
        return self.read(table) if self.exists(table) else self.spark.createDataFrame([], schema)

    def _put(self, table: str, df: DataFrame, operation: str, partition: str | None, month_of: str | None, keep: Sequence[str] = (), before=None, counts: tuple[int, int, int] | None = None) -> int:
        """Commits the rows of df and the directories of the version before that are kept."""
        return self._stage(table, df, operation, partition, month_of, keep, before, counts).commit()

    def _stage(self, table: str, df: DataFrame, operation: str, partition: str | None, month_of: str | None, keep: Sequence[str] = (), before=None, counts: tuple[int, int, int] | None = None, observe: Sequence[Column] = ()) -> Staged:
        """Writes the rows of df as files of the next version, which is none until it is committed. What is counted of them is counted while they are written."""
        n = (self.version(table) or 0) + 1
        columns = df.columns
        seen = Observation()
        df = df.observe(seen, F.count("*").alias("_written"), *observe)
        if month_of:
            df = df.withColumn(partition, F.trunc(month_of, "MM"))
        own = f"_commit={n}"
        path = f"{self.root}/{table}/{own}"
        writer = df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        (writer.partitionBy(partition) if partition else writer).parquet(path)
        p, fs = path_of(self.spark, path)
        made = [f"{own}/{s.getPath().getName()}" for s in fs.listStatus(p) if s.isDirectory()] if partition else [own]
        schema = StructType([*df.schema.fields, *([f for f in StructType.fromJson(json.loads(before["schema"])).fields if f.name not in df.columns] if before is not None else [])])
        got = seen.get
        written, rows = got["_written"], got["_written"]
        if before is not None:  # of the version before only the directories that go are counted
            gone = [d for d in before["parts"] if d not in set(keep)]
            rows += before["rows"] - (self._rows(table, before, gone).count() if gone and keep else before["rows"] if gone else 0)
        added, updated, deleted = counts or (written, 0, 0)
        row = (n, None, operation, rows, added, updated, deleted, partition, written, month_of, schema.json(), [*keep, *made])
        fresh = self.spark.createDataFrame([], df.schema) if not made else self.spark.read.schema(df.schema).option("basePath", path).parquet(*[f"{self.root}/{table}/{m}" for m in made])
        return Staged(self, table, row, fresh.select(*[f"`{c}`" for c in columns]), {k: v for k, v in got.items() if k != "_written"} | {"rows": written})

    def stage(self, table: str, df: DataFrame, by_month: str | None = None, observe: Sequence[Column] = ()) -> Staged:
        """The rows of df as files of the table's next version, to be committed later, with aggregates of them taken while they were written."""
        return self._stage(table, df, "replace", f"{by_month}_month" if by_month else None, by_month, observe=observe)

    def write(self, table: str, df: DataFrame, by_month: str | None = None, by: str | None = None, operation: str = "replace") -> int:
        """Commits df as the next version. by_month: a date column by whose month files are parted; by: a column itself."""
        return self._put(table, df, operation, f"{by_month}_month" if by_month else by, by_month)

    def append(self, table: str, df: DataFrame) -> int:
        """Commits the rows besides those that are there; the table is made where there is none. Writes the new rows alone."""
        if not self.exists(table):
            return self.write(table, df, operation="append")
        before = self._commit(table, self.version(table))
        return self._put(table, df, "append", before["partition_column"], before["month_of"], before["parts"], before)

    def replace_where(self, table: str, df: DataFrame, column: str, value) -> int:
        """Commits a version in which the rows with column = value are those of df. Writes them alone, once the table is parted by the column."""
        if not self.exists(table):
            return self.write(table, df, by=column, operation="replace_partition")
        before = self._commit(table, self.version(table))
        if before["partition_column"] == column and before["month_of"] is None:
            mine = DEFAULT if value is None else str(value)
            kept = [p for p in before["parts"] if p.partition("/")[2] != f"{column}={mine}"]
            return self._put(table, df, "replace_partition", column, None, kept, before)
        others = self._rows(table, before, before["parts"]).where(~F.col(column).eqNullSafe(F.lit(value)))
        return self._put(table, others.unionByName(df, allowMissingColumns=True), "replace_partition", column, None)

    @staticmethod
    def _differing(target: DataFrame, source: DataFrame, partition: str, columns: Sequence[str]) -> set[str]:
        """The partitions whose rows are not the same on both sides, by digests that do not depend on the order of rows: their number and the
        sums of two hashes of each."""

        def digests(df: DataFrame) -> dict:
            row = F.struct(*sorted(columns))
            sums = [F.sum(h.cast("decimal(38,0)")).alias(f"h{i}") for i, h in enumerate((F.xxhash64(row), F.xxhash64(row, F.lit(1)), F.hash(row)))]
            found = df.groupBy(F.coalesce(F.col(partition).cast("string"), F.lit(DEFAULT)).alias("p")).agg(F.count("*").alias("n"), *sums).collect()  # a row a partition
            return {r["p"]: tuple(r)[1:] for r in found}

        ours, theirs = digests(target), digests(source)
        return {p for p in ours.keys() | theirs.keys() if ours.get(p) != theirs.get(p)}

    def merge(self, table: str, source: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None, by_month: str | None = None) -> int:
        """Upserts source and deletes what it lacks; rows that only differ elsewhere than in `compare` stay as they were.

        Where the table is parted, digests of its partitions and of the source's tell which can hold a change: those alone are joined. Then the
        directories that hold a changed row are written anew. A row that moves from a partition to another changes the digests of both."""
        if not self.exists(table):
            return self.write(table, source, by_month=by_month, operation="bootstrap")
        before = self._commit(table, self.version(table))
        partition, month_of, keys = before["partition_column"], before["month_of"], list(keys)
        if month_of:
            source = source.drop(partition).withColumn(partition, F.trunc(month_of, "MM"))
        parts = list(before["parts"])
        if partition:
            source = cut(source)  # it is read for its digests, and what differs of it again
            shared = [c for c in source.columns if c in StructType.fromJson(json.loads(before["schema"])).names]
            differing = self._differing(self._rows(table, before, parts), source, partition, shared)
            parts = [p for p in parts if p.partition("/")[2].partition("=")[2] in differing]
            inside = F.coalesce(F.col(partition).cast("string"), F.lit(DEFAULT)).isin(sorted(differing))
            source = source.where(inside)
        target = self._rows(table, before, parts)
        where = [partition] if partition else []
        changes = merged(target.select(*[c for c in source.columns if c in target.columns]), source, keys, compare, old=where).where("action <> 'kept'")
        return self._changed(table, before, changes, keys, "merge")

    def upsert(self, table: str, source: DataFrame, keys: Sequence[str], by: str, by_month: str | None = None, operation: str = "upsert") -> int:
        """Commits the rows of source where they are the newest of their key by `by` (ties as `latest` has them); all other rows stay. Rows that lack a key are left out.

        Of the table only rows of the source's keys are carried, and the directories that hold a changed row are written anew."""
        keys = list(keys)
        source = cut(latest(source.dropna(subset=keys), keys, by))
        if not self.exists(table):
            return self.write(table, source, by_month=by_month, operation=operation)
        before = self._commit(table, self.version(table))
        partition, month_of = before["partition_column"], before["month_of"]
        columns = source.columns
        if month_of:
            source = source.withColumn(partition, F.trunc(month_of, "MM"))
        held = self._rows(table, before, before["parts"]).select(*source.columns).join(source.select(*keys), keys, "left_semi").select(*source.columns)
        newest = latest(held.unionByName(source), keys, by, [c for c in columns if c != by and c not in keys])
        changes = merged(held, newest, keys, old=[partition] if partition else []).where("action <> 'kept'")
        return self._changed(table, before, changes, keys, operation)

    def _changed(self, table: str, before, changes: DataFrame, keys: Sequence[str], operation: str) -> int:
        """Commits changes (action, columns, was_<partition>): the directories that hold one are written anew."""
        partition, month_of = before["partition_column"], before["month_of"]
        where = [partition] if partition else []
        changes = cut(changes)
        found = changes.groupBy("action", *[c for w in where for c in (w, f"was_{w}")]).agg(F.count("*").alias("n")).collect()  # a row a partition and action
        counts = tuple(sum(r["n"] for r in found if r["action"] == a) for a in ("inserted", "updated", "deleted"))
        if partition:
            touched = {(DEFAULT if r[c] is None else str(r[c])) for r in found for c, in_ in ((partition, ("inserted", "updated", "deleted")), (f"was_{partition}", ("updated",))) if r["action"] in in_}
            old = [p for p in before["parts"] if p.partition("/")[2].partition("=")[2] in touched]
        else:
            old = list(before["parts"]) if found else []
        gone = changes.where("action <> 'inserted'").select(*[F.col(k).alias(f"g_{k}") for k in keys])
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"g_{k}"))
        rows = self._rows(table, before, old).join(gone, same, "left_anti").unionByName(changes.where("action <> 'deleted'").drop("action", *[f"was_{w}" for w in where]), allowMissingColumns=True)
        return self._put(table, rows, operation, partition, month_of, [p for p in before["parts"] if p not in set(old)], before, counts)


def merged(target: DataFrame, source: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None, old: Sequence[str] = ()) -> DataFrame:
    """A row for each key of either side with its action: inserted, updated, deleted, kept. Nulls equal nulls.

    old: columns of which the target's value comes along, as was_<name>."""
    keys, columns = list(keys), source.columns
    compare = list(compare) if compare is not None else [c for c in columns if c not in keys]
    t = target.select(*[F.col(k).alias(f"t_{k}") for k in keys], F.struct(*columns).alias("t"))
    s = source.select(*[F.col(k).alias(f"s_{k}") for k in keys], F.struct(*columns).alias("s"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}"))
    both = t.join(s, same, "full")
    changed = F.lit(False)
    for c in compare:
        changed = changed | differs(F.col(f"t.{c}"), F.col(f"s.{c}"))
    action = F.when(F.col("t").isNull(), "inserted").when(F.col("s").isNull(), "deleted").when(changed, "updated").otherwise("kept")
    row = F.when(action.isin("inserted", "updated"), F.col("s")).otherwise(F.col("t"))
    return both.select(action.alias("action"), row.alias("r"), *[F.col(f"t.{c}").alias(f"was_{c}") for c in old]).select("action", "r.*", *[f"was_{c}" for c in old])


def script(text: str) -> list[str]:
    """The statements of an SQL script: comment lines go, statements end with a semicolon at the end of a line."""
    lines = [x for x in text.splitlines() if not x.lstrip().startswith("--")]
    return [s.strip() for s in "\n".join([*lines, ""]).split(";\n") if s.strip()]


def run_script(spark: SparkSession, text: str) -> list[tuple[str, float]]:
    """Runs the statements in order; each with the seconds it took."""
    import time

    out = []
    for statement in script(text):
        began = time.monotonic()
        spark.sql(statement).collect() if statement.lower().startswith(("create", "drop", "set", "use", "refresh")) else spark.sql(statement).write.format("noop").mode("overwrite").save()
        out.append((statement, time.monotonic() - began))
    return out

"""Stored tables: typed scans, and writes that become visible in one step."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from orderloom.functions.dates import moment
from orderloom.model import TABLES

_LOG = "table STRING, version INT, at TIMESTAMP_NTZ, part STRING, batch STRING, top BIGINT"


@dataclass(frozen=True)
class Entry:
    """A version to be published: of a whole table, or of one part of it."""

    table: str
    version: int
    part: str | None = None
    top: int | None = None


def scan(spark: SparkSession, path: str, schema) -> DataFrame:
    """A parquet scan with declared, never inferred, columns."""
    return spark.read.schema(schema).parquet(path)


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def numbers(spark: SparkSession, n: int) -> DataFrame:
    """The numbers 1 .. n in column ``n``."""
    return spark.range(1, n + 1).withColumnRenamed("id", "n")


@dataclass(frozen=True)
class Content:
    """What a table consists of: the version written as a whole, the parts added since, and the highest key handed out
    so far, if the newest version came with it."""

    whole: int | None
    parts: dict[str, int]
    top: int | None

    @property
    def versions(self) -> list[int]:
        return sorted([v for v in (self.whole,) if v is not None] + list(self.parts.values()))


class TableStore:
    """Tables as parquet below ``root``.

    Every version is a folder of its own, which becomes visible when it is named in the publish log; one append to the
    log can publish many tables, and readers see all of them or none. A version is a table as a whole, or a part of
    one: a part stands beside the others, and a later version of the same part takes its place. A version of the whole
    table ends all parts before it. Large facts are not rewritten as a whole: ``append`` and ``replace_partitions``
    work on the current version, and a query that is reading the swapped partitions meanwhile has to be run again.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._known: tuple[dict[str, Content], set[str]] | None = None

    def _log_path(self) -> str:
        return f"{self.root}/_published"

    def _published(self) -> tuple[dict[str, Content], set[str]]:
        """The content of every table and the batches stored so far; one row per part and batch comes back."""
        if self._known is None:
            try:
                log = self.spark.read.schema(_LOG).json(self._log_path())
                rows = log.groupBy("table", "part", "batch").agg(
                    F.max("version").alias("version"), F.max("top").alias("top")).collect()
            except AnalysisException:
                rows = []
            contents = {}
            for name in {r["table"] for r in rows}:
                own = [r for r in rows if r["table"] == name]
                whole = max((r["version"] for r in own if r["part"] is None), default=None)
                parts: dict[str, int] = {}
                for r in own:
                    if r["part"] is not None and r["version"] > (whole or 0):
                        parts[r["part"]] = max(r["version"], parts.get(r["part"], 0))
                newest = max(own, key=lambda r: r["version"])
                contents[name] = Content(whole, parts, newest["top"])
            self._known = contents, {r["batch"] for r in rows if r["batch"] is not None}
        return self._known

    def content(self, name: str) -> Content:
        return self._published()[0].get(name, Content(None, {}, None))

    def versions(self) -> dict[str, int]:
        """The newest version of every published table."""
        return {name: max(c.versions) for name, c in self._published()[0].items()}

    def stored(self, batch: str) -> bool:
        """Whether the batch was published."""
        return batch in self._published()[1]

    def exists(self, name: str) -> bool:
        return name in self._published()[0]

    def path(self, name: str, version: int) -> str:
        return f"{self.root}/{TABLES[name].layer}/{name}/v={version:06d}"

    def read(self, name: str, part: str | None = None) -> DataFrame:
        """The current rows of a table, or of one part of it; an empty table if there are none."""
        content = self.content(name)
        found = content.versions if part is None else [content.parts[part]] if part in content.parts else []
        schema = TABLES[name].schema
        if not found:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[self.path(name, version) for version in found])

    def stage(self, name: str, df: DataFrame, partition_by: Sequence[str] = (), ahead: int = 1,
              onto: int | None = None) -> int:
        """Write a version that nobody sees yet, and return its number, ``ahead`` of the newest one; or add to the one
        numbered ``onto``, which was staged before."""
        version = self.versions().get(name, 0) + ahead if onto is None else onto
        columns = [f.name for f in TABLES[name].schema.fields]
        writer = df.select(*columns, *[c for c in partition_by if c not in columns]).write.mode(
            "overwrite" if onto is None else "append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name, version))
        return version

    def staged(self, name: str, version: int) -> DataFrame:
        return scan(self.spark, self.path(name, version), TABLES[name].schema)

    def publish(self, versions: Mapping[str, int], at: datetime) -> None:
        """Make the given versions current, all at once."""
        self.enter([Entry(name, version) for name, version in versions.items()], at)

    def enter(self, entries: Sequence[Entry], at: datetime, batch: str | None = None) -> None:
        """Publish versions of tables and of parts by one entry in the log, under the name of a batch if there is one."""
        rows = F.array(*[F.struct(
            F.lit(e.table).alias("table"), F.lit(e.version).alias("version"), moment(at).alias("at"),
            F.lit(e.part).cast("string").alias("part"), F.lit(batch).cast("string").alias("batch"),
            F.lit(e.top).cast("long").alias("top")) for e in entries])
        # One task, hence one file: the log gains all rows or none.
        self.spark.range(0, 1, 1, 1).select(F.inline(rows)).write.mode("append").json(self._log_path())
        self._known = None

    def store_batch(self, batch: str, at: datetime, added: Mapping[str, DataFrame],
                    replaced: Mapping[str, DataFrame] | None = None, top: Mapping[str, int] | None = None) -> bool:
        """Add rows to some tables and replace others, all of it visible by one entry; False, and nothing done, if a
        batch of this name is stored already.

        A batch that dies before its entry has left nothing that a reader sees, and can be stored again. ``replaced``
        may be computed from the tables as they are. ``top`` gives the highest key a batch used for a table, from which
        the next batch goes on. Batches are stored one after the other.
        """
        self._known = None  # another process may have stored it
        if self.stored(batch):
            return False
        entries = [Entry(name, self.stage(name, df), f"batch-{batch}", (top or {}).get(name))
                   for name, df in added.items()]
        entries += [Entry(name, self.stage(name, df), None, (top or {}).get(name))
                    for name, df in (replaced or {}).items()]
        self.enter(entries, at, batch)
        return True

    def write(self, name: str, df: DataFrame, at: datetime, partition_by: Sequence[str] = ()) -> None:
        """Replace a table."""
        self.publish({name: self.stage(name, df, partition_by)}, at)

    def append(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> None:
        """Add rows to the current version of a table; its files so far stay untouched."""
        current = self.content(name).whole
        columns = [f.name for f in TABLES[name].schema.fields]
        writer = df.select(*columns, *[c for c in partition_by if c not in columns]).write.mode("append")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(self.path(name, current))

    def replace_partitions(self, name: str, df: DataFrame, partition_by: Sequence[str]) -> None:
        """Swap the partitions that ``df`` holds rows of; all others stay. ``df`` must not read this table."""
        current = self.content(name).whole
        columns = [f.name for f in TABLES[name].schema.fields]
        (df.select(*columns, *[c for c in partition_by if c not in columns]).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
         .parquet(self.path(name, current)))

"""Keyed parquet tables partitioned by day: scan, create-if-absent, idempotent atomic upsert."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from seriesforge.config import SeriesSpec
from seriesforge.operators.quality import keep_last
from seriesforge.session import discard, file_system, fresh_path
from seriesforge.sources.edges import edge_tables

PARTITION, VERSION = "date", "version"
# Manifests kept besides the newest, with the day folders they name: what running readers may hold.
KEPT = 1


class KeyedTable:
    """Parquet days with one row per (key, time); a manifest names the folder of each UTC day.

    Days, not series, are the partitions: their number does not grow with the sensors. Within
    a day files are laid out by key, so that a filter on the key skips row groups. An upsert
    writes new folders for its days and then publishes them all by one rename of the next
    manifest: readers see the table before or after it, and a failure in between leaves it as it was.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, spec: SeriesSpec = SeriesSpec()):
        self.spark, self.path, self.schema, self.spec = spark, path.rstrip("/"), schema, spec

    def _manifests(self) -> list[int]:
        fs, folder = file_system(self.spark, f"{self.path}/manifests")
        if not fs.exists(folder):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.removesuffix(".json").isdigit())

    def _manifest(self, number: int) -> dict[str, str]:
        fs, file = file_system(self.spark, f"{self.path}/manifests/{number}.json")
        stream = fs.open(file)
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return json.loads(text)

    def _publish(self, number: int, days: dict[str, str]) -> None:
        """Make ``days`` the table: the file is complete before it gets its name."""
        fs, draft = file_system(self.spark, f"{self.path}/manifests/_{uuid.uuid4().hex}")
        _, name = file_system(self.spark, f"{self.path}/manifests/{number}.json")
        stream = fs.create(draft)
        try:
            stream.write(json.dumps(days).encode())
        finally:
            stream.close()
        if fs.exists(name) or not fs.rename(draft, name):
            fs.delete(draft, False)
            raise RuntimeError(f"{self.path}: another writer published version {number} first")

    def _current(self) -> tuple[int, dict[str, str]]:
        """Newest manifest: its number (0 for an absent table) and the version of each day."""
        numbers = self._manifests()
        return (numbers[-1], self._manifest(numbers[-1])) if numbers else (0, {})

    def folders(self, name: str) -> list[str]:
        """Names of what lies in a folder of the table; none if there is no such folder."""
        fs, folder = file_system(self.spark, f"{self.path}/{name}")
        return sorted(status.getPath().getName() for status in fs.listStatus(folder)) if fs.exists(folder) else []

    def days(self) -> list[str]:
        """The days that hold rows, ascending."""
        return sorted(self._current()[1])

    def exists(self) -> bool:
        return bool(self._manifests())

    def create(self) -> KeyedTable:
        """Publish an empty table unless there is one."""
        if not self.exists():
            self._publish(1, {})
        return self

    def _with_day(self, df: DataFrame) -> DataFrame:
        return df.withColumn(PARTITION, F.to_date(self.spec.ts))

    def _read(self, days: dict[str, str]) -> DataFrame:
        stored = StructType([*self.schema.fields, StructField(VERSION, StringType()), StructField(PARTITION, DateType())])
        if not days:
            return self.spark.createDataFrame([], stored).drop(VERSION)
        base = f"{self.path}/data"
        folders = [f"{base}/{VERSION}={v}/{PARTITION}={d}" for d, v in sorted(days.items())]
        return self.spark.read.schema(stored).option("basePath", base).parquet(*folders).drop(VERSION)

    def scan(self) -> DataFrame:
        """The whole table; an absent one is empty."""
        return self._read(self._current()[1]).drop(PARTITION)

    def scan_days(self, first=None, last=None) -> DataFrame:
        """Rows from the first to the last day; the folders of other days are not even listed."""
        low, high = str(first or ""), str(last or "9999-12-31")
        return self._read({d: v for d, v in self._current()[1].items() if low <= d <= high}).drop(PARTITION)

    def scan_on(self, days: list) -> DataFrame:
        """Rows of the listed days; the other partitions are not read."""
        wanted = {str(d) for d in days}
        return self._read({d: v for d, v in self._current()[1].items() if d in wanted}).drop(PARTITION)

    def _batch(self, rows: DataFrame) -> DataFrame:
        return self._with_day(rows.select(*self.schema.names).dropna(subset=[self.spec.key, self.spec.ts]))

    def _days(self, batch: DataFrame) -> list[str]:
        """One value per calendar day, so this list stays short."""
        return sorted(str(r[0]) for r in batch.select(PARTITION).distinct().collect())

    def changes(self, rows: DataFrame) -> DataFrame:
        """The rows that an upsert would store: new (key, time), or other content under no smaller ``seq``.

        ``rows`` is read twice: hand in a stored table. Only the days it falls on are read.
        """
        spec, batch = self.spec, self._batch(rows)
        batch = batch.join(self._kept(self._days(batch)), [spec.key, spec.ts], "left")
        same = F.struct(*self.schema.names).eqNullSafe(F.col("_stored"))
        older = F.coalesce(F.col(spec.seq) < F.col(f"_stored.{spec.seq}"), F.lit(False))
        return batch.filter(F.col("_stored").isNull() | ~(same | older)).select(*self.schema.names)

    def _kept(self, days: list[str]) -> DataFrame:
        """(key, time, the whole row) of the stored days."""
        stored = self.scan_on(days)
        return stored.select(self.spec.key, self.spec.ts, F.struct(*self.schema.names).alias("_stored"))

    def upsert(self, rows: DataFrame, stored: bool = False) -> None:
        """Merge rows by (key, time). Only the days they fall on are rewritten.

        The greater ``seq`` wins; of equal ones the new row, so a recomputed row replaces the
        stored one. Running the same batch again changes nothing. The batch is written aside first, so
        its source is read once (not if it is ``stored`` already); the merged days are written once, to
        their final place. Edge tables of this table get the batch first: a failure in between is
        mended by the rerun that the batch needs anyway.
        """
        spec = self.spec
        number, known = self._current()
        batch = self._batch(rows)
        staged = None
        if not stored:
            staged = fresh_path(self.spark, "upsert-batch")
            batch.write.parquet(staged)
            batch = self.spark.read.schema(batch.schema).parquet(staged)
        days = self._days(batch)
        for edges in edge_tables(self):
            edges.add(batch.drop(PARTITION))
        if days:
            old = self._read({d: known[d] for d in days if d in known})
            both = old.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
            merged = self._with_day(keep_last(both.drop(PARTITION), spec, ties="_new").drop("_new"))
            version = uuid.uuid4().hex
            # Rebalancing splits an oversized day over several tasks and files.
            (merged.hint("rebalance", PARTITION).sortWithinPartitions(PARTITION, spec.key, spec.ts)
             .write.partitionBy(PARTITION).parquet(f"{self.path}/data/{VERSION}={version}"))
            self._publish(number + 1, known | {d: version for d in days})
            self._retire()
        if staged:
            discard(self.spark, staged)

    def _retire(self) -> None:
        """Drop all but the newest manifests, and day folders that none of those left names."""
        numbers = self._manifests()
        stays, goes = numbers[-1 - KEPT:], numbers[:-1 - KEPT]
        named = {item for n in stays for item in self._manifest(n).items()}
        for n in goes:
            for day, version in self._manifest(n).items():
                if (day, version) not in named:
                    discard(self.spark, f"{self.path}/data/{VERSION}={version}/{PARTITION}={day}")
            discard(self.spark, f"{self.path}/manifests/{n}.json")

"""Versioned history tables and roll-ups that follow their corrections.

The batch layer does not only compare what the stream has written with its own
result, it corrects it.  A ``History`` is a partitioned table whose partitions
are immutable folders, and a manifest per version that lists the folders of the
version.  A correction writes the partitions in which a row differs, and no
others, into new folders; then the new manifest is put in place with one
rename.  A reader keeps the version it has opened; a writer that is lost before
the rename leaves the table as it was.  One writer at a time: two that make the
same version collide at the rename.

``WardRollup`` keeps mergeable sums per ward and day next to such a table.  After
a correction it reads the partitions whose folders changed, replaces their sums
(a maximum cannot be taken back from a larger sum, so the day is the unit of
retraction) and merges days to weeks or months.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from civicflow.session import materialize


def same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    """Equality of columns of two tables, nulls being equal."""
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


class History:
    """The versioned table in folder ``root``; ``create`` makes one, ``open`` finds one."""

    def __init__(self, spark: SparkSession, root: str, schema: T.StructType, partition: list[str]):
        self.spark, self.root, self.schema, self.partition = spark, root.rstrip("/"), schema, list(partition)

    @classmethod
    def create(cls, df: DataFrame, root: str, partition: list[str]) -> History:
        """A new table; its version 1 is ``df``."""
        spark = df.sparkSession
        out = cls(spark, root, df.schema, partition)
        spark.createDataFrame([(df.schema.json(), list(partition))], "schema string, partition array<string>").write.json(f"{out.root}/layout")
        out._commit(out._write(df, 1), 1)
        return out

    @classmethod
    def open(cls, spark: SparkSession, root: str) -> History:
        layout = spark.read.schema("schema string, partition array<string>").json(f"{root.rstrip('/')}/layout").first()
        return cls(spark, root, T.StructType.fromJson(json.loads(layout["schema"])), layout["partition"])

    # -- files

    def _fs(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _write(self, df: DataFrame, version: int) -> DataFrame:
        """Write ``df`` into folders of this version; its part of a manifest."""
        place = f"{self.root}/data/v={version}-{uuid.uuid4().hex[:8]}"
        (df.select(*self.schema.fieldNames()).repartition(*self.partition)
         .write.partitionBy(*self.partition).parquet(place))
        uri = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))  # a plus is no space here
        found = self._rows([place], place).select(*self.partition, F.regexp_extract(F.url_decode(uri), "^(.*)/", 1).alias("folder"))
        return found.distinct().withColumn("base", F.lit(place))

    def _rows(self, folders: list[str], base: str) -> DataFrame:
        return self.spark.read.schema(self.schema).option("basePath", base).parquet(*folders)

    def _commit(self, manifest: DataFrame, version: int) -> None:
        draft = f"{self.root}/drafts/{uuid.uuid4().hex}"
        manifest.select(*self.partition, "folder", "base").write.parquet(draft)
        source, fs = self._fs(draft)
        target, _ = self._fs(f"{self.root}/manifests/v={version}")
        fs.mkdirs(target.getParent())
        if fs.exists(target) or not fs.rename(source, target):
            raise RuntimeError(f"version {version} of {self.root} was made by another writer")

    # -- versions

    def version(self) -> int:
        """The newest version."""
        folder, fs = self._fs(f"{self.root}/manifests")
        return max(int(f.getPath().getName()[2:]) for f in fs.listStatus(folder))

    def manifest(self, version: int | None = None) -> DataFrame:
        """Partition columns, folder and base of every folder of a version."""
        return self.spark.read.parquet(f"{self.root}/manifests/v={version or self.version()}")

    def read(self, version: int | None = None, only: DataFrame | None = None) -> DataFrame:
        """The rows of a version; of the partitions listed in ``only``, if it is given.
        The folders are named to Spark, which opens no others."""
        listed = self.manifest(version)
        if only is not None:
            listed = listed.join(only, same(listed, only, self.partition), "left_semi")
        bases: dict[str, list[str]] = {}
        for row in listed.select("base", "folder").collect():  # names of folders, as in Spark's own file index
            bases.setdefault(row["base"], []).append(row["folder"])
        out = self.spark.createDataFrame([], self.schema)
        for i, (base, folders) in enumerate(sorted(bases.items())):
            part = self._rows(folders, base).select(*self.schema.fieldNames())
            out = part if i == 0 else out.unionByName(part)
        return out

    def append(self, df: DataFrame) -> int:
        """A new version with the rows of ``df`` added."""
        version = self.version()
        self._commit(self.manifest(version).unionByName(self._write(df, version + 1)), version + 1)
        return version + 1

    def differing(self, truth: DataFrame, key: list[str], tolerance: float = 1e-9) -> DataFrame:
        """The partitions in which a row of ``truth`` is missing, other or too much.
        Doubles may differ by ``tolerance`` of their size (sums add up in any order)."""
        old = self.read().alias("o")
        new = truth.select(*self.schema.fieldNames()).alias("n")
        on = F.lit(True)
        for c in dict.fromkeys([*self.partition, *key]):
            on = on & F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}"))
        present = F.lit(True)
        old, new = old.withColumn("_here", present).alias("o"), new.withColumn("_here", present).alias("n")
        differs = F.col("o._here").isNull() | F.col("n._here").isNull()
        for f in self.schema.fields:
            if f.name in key or f.name in self.partition:
                continue
            a, b = F.col(f"o.{f.name}"), F.col(f"n.{f.name}")
            if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
                close = F.abs(a - b) <= tolerance * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))
                differs = differs | ~(a.eqNullSafe(b) | F.coalesce(close, F.lit(False)))
            else:
                differs = differs | ~a.eqNullSafe(b)
        where = [F.when(F.col("n._here").isNull(), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c) for c in self.partition]
        return old.join(new, on, "full_outer").where(differs).select(*where).distinct()

    def correct(self, truth: DataFrame, key: list[str], tolerance: float = 1e-9) -> tuple[int, DataFrame]:
        """Make the table equal to ``truth`` (one row per ``key``) by rewriting the
        partitions that differ; (version, corrected partitions).  No new version if
        none differs."""
        version = self.version()
        changed = materialize(self.differing(truth, key, tolerance), "history-changed")
        if changed.isEmpty():
            return version, changed
        rows = truth.join(changed, same(truth, changed, self.partition), "left_semi")
        kept = self.manifest(version)
        kept = kept.join(changed, same(kept, changed, self.partition), "left_anti")
        self._commit(kept.unionByName(self._write(rows, version + 1)), version + 1)
        return version + 1, changed


SUMS = "total_kwh_consumed double, pf_sum double, n_power_factors long, n_readings long, peak_voltage double"


def daily_sums(history: DataFrame) -> DataFrame:
    """Mergeable sums per ward and day of the 15-minute history."""
    return history.groupBy("ward_id", "date").agg(
        F.sum("total_kwh_consumed").alias("total_kwh_consumed"),
        F.sum(F.col("avg_power_factor") * F.col("n_power_factors")).alias("pf_sum"),
        F.sum("n_power_factors").alias("n_power_factors"), F.sum("n_readings").alias("n_readings"),
        F.max("peak_voltage").alias("peak_voltage"))


class WardRollup:
    """Weekly and monthly ward totals over a ``History`` partitioned by ward and day."""

    def __init__(self, history: History, root: str):
        self.history, self.root, self.spark = history, root.rstrip("/"), history.spark

    def _done(self) -> int:
        folder, fs = self.history._fs(f"{self.root}/sums")
        names = [f.getPath().getName() for f in fs.listStatus(folder)] if fs.exists(folder) else []
        complete = [n for n in names if fs.exists(self.history._fs(f"{self.root}/sums/{n}/_SUCCESS")[0])]
        return max([int(n.split("=")[1]) for n in complete], default=0)

    def changed(self, before: int, after: int) -> DataFrame:
        """Partitions whose folders differ between two versions (0: the empty table)."""
        new = self.history.manifest(after).select("ward_id", "date", "folder")
        if not before:
            return new.select("ward_id", "date").distinct()
        old = self.history.manifest(before).select("ward_id", "date", "folder")
        either = old.exceptAll(new).unionByName(new.exceptAll(old))
        return either.select("ward_id", "date").distinct()

    def refresh(self) -> DataFrame:
        """Bring the sums to the newest version; the partitions that were read."""
        before, after = self._done(), self.history.version()
        changed = materialize(self.changed(before, after), "rollup-changed") if after != before else self.changed(after, after)
        if after != before:
            sums = daily_sums(self.history.read(after, only=changed))
            gone = sums["ward_id"].isNull() & sums["n_readings"].isNull()
            told = changed.join(sums, same(changed, sums, ["ward_id", "date"]), "left").select(
                changed["ward_id"], changed["date"], *[c.split()[0] for c in SUMS.split(", ")], gone.alias("removed"))
            told.write.mode("overwrite").parquet(f"{self.root}/sums/version={after}")
        return changed

    def days(self) -> DataFrame:
        """Current sums per ward and day: the newest told for each."""
        schema = f"ward_id string, date date, {SUMS}, removed boolean, version int"
        log = self.spark.read.schema(schema).parquet(f"{self.root}/sums")
        names = [c.split()[0] for c in SUMS.split(", ")]
        newest = log.groupBy("ward_id", "date").agg(F.max_by(F.struct(*names, "removed"), "version").alias("s"))
        return newest.where("NOT s.removed").select("ward_id", "date", *[F.col(f"s.{n}").alias(n) for n in names])

    def totals(self, unit: str) -> DataFrame:
        """Totals per ward and ``week`` or ``month``, as ``windows.rollup_history`` gives them."""
        period = F.date_trunc(unit, F.col("date").cast("timestamp")).alias("period_start")
        return self.days().groupBy("ward_id", period).agg(
            F.sum("total_kwh_consumed").alias("total_kwh_consumed"),
            (F.sum("pf_sum") / F.sum("n_power_factors")).alias("avg_power_factor"),
            F.max("peak_voltage").alias("peak_voltage"), F.sum("n_readings").alias("n_readings"))

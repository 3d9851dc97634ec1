"""Table store: named tables, as catalog tables or as files under the shared folder.

``TableStore(spark, database="gold")`` writes with ``saveAsTable`` and reads
with ``spark.table``, so SQL users find the tables by name. Without a database
a table is a directory under a root: the one given, or a new folder next to
``spark.checkpoint.dir`` for each store, so that two runs never overwrite each
other's tables while a lazy reader still needs them. Partition pruning and column pruning
apply on read either way. ``fmt`` may name any installed format (parquet by
default; delta when its jar is present).

Folders that nobody named (``TableStore(spark)``, ``run_folder``) and stores opened
with ``temporary=True`` belong to the driver's run: they go when the driver ends, when
``remove_temporary`` is called, or at the end of a ``with`` block. Stores with a root
or a database name stay.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without one (tests, the bench) gets a private
    folder, registered as the checkpoint dir. On a cluster a machine-local
    folder would not be shared by the executors, so a missing setting is an
    error there rather than a silent fallback.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                               "(checkpoints and tables are written there)")
        d = tempfile.mkdtemp(prefix="roadrisk-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    d = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared storage through Hadoop's file systems."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


_temporary: dict[str, tuple[SparkSession, str | None]] = {}  # folder -> its session and, if it has one, its database


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, kept until the driver ends or ``remove_temporary``."""
    folder = f"{shared_dir(spark)}/roadrisk-tables/{name}-{uuid.uuid4().hex}"
    _temporary[folder] = (spark, None)
    return folder


@atexit.register
def remove_temporary(*folders: str) -> None:
    """Drop temporary folders and databases: the given ones, or all of this driver. Lazy
    results that still read them must have been written or collected by then."""
    for folder in folders or list(_temporary):
        spark, database = _temporary.pop(folder, (None, None))
        if spark is None:
            continue
        with contextlib.suppress(Exception):  # the session may be gone, and its catalog with it
            if database is not None:
                spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
        with contextlib.suppress(Exception):
            delete_path(spark, folder)


class TableStore:
    """Named tables of one run (a folder) or of one catalog database."""

    def __init__(self, spark: SparkSession, root: str | None = None, fmt: str = "parquet", database: str | None = None,
                 temporary: bool | None = None):
        self.spark = spark
        self.fmt = fmt
        self.database = database
        self.temporary = root is None and database is None if temporary is None else temporary
        self.root = (root or run_folder(spark, "store")).rstrip("/")
        if self.temporary:
            _temporary[self.root] = (spark, database)
        else:
            _temporary.pop(self.root, None)
        if database is not None:  # a new database keeps its files below the shared folder too
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}'")

    def __enter__(self) -> TableStore:
        return self

    def __exit__(self, *_) -> None:
        if self.temporary:
            remove_temporary(self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> str:
        """The name under which SQL finds a catalog table."""
        return f"`{self.database}`.`{name}`"

    def write(self, df: DataFrame, name: str, mode: str = "overwrite",
              partition_by: list[str] | None = None) -> str:
        """Overwrite or append a table, optionally partitioned.

        A partitioned write is clustered on the partition columns first, with
        ``rebalance``: a partition is written by few tasks, and a large one is
        split by its size, not written by one task."""
        if partition_by:
            df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        w = df.write.format(self.fmt).mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if self.database is not None:
            w.saveAsTable(self.table(name))
            return self.table(name)
        w.save(self.path(name))
        return self.path(name)

    def write_counted(self, df: DataFrame, name: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> int:
        """Write a table and return the number of rows written, observed in the write itself:
        no second job and no second scan (S16)."""
        seen = Observation(f"rows-{uuid.uuid4().hex}")
        self.write(df.observe(seen, F.count(F.lit(1)).alias("n")), name, mode, partition_by)
        return seen.get["n"]

    def exists(self, name: str) -> bool:
        if self.database is not None:
            return self.spark.catalog.tableExists(self.table(name))
        target = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def replace_partitions(self, df: DataFrame, name: str, partition_by: list[str]) -> None:
        """Overwrite the partitions that ``df`` has rows for and leave all others, files
        included, as they are; the table is made on its first write. ``df`` must not
        read what it overwrites (store it first)."""
        if not self.exists(name):
            self.write(df, name, partition_by=partition_by)
            return
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        if self.database is None:
            w = df.write.option("partitionOverwriteMode", "dynamic").format(self.fmt).mode("overwrite")
            w.partitionBy(*partition_by).save(self.path(name))
            return
        columns = self.spark.table(self.table(name)).columns  # insertInto goes by position, and by the session's mode
        mode, conf = "spark.sql.sources.partitionOverwriteMode", self.spark.conf
        before = conf.get(mode)
        conf.set(mode, "dynamic")
        try:
            df.select(*columns).write.insertInto(self.table(name), overwrite=True)
        finally:
            conf.set(mode, before)

    def drop_partition(self, name: str, column: str, value) -> None:
        """Remove one value of the partition column ``column`` (not NULL) with its files."""
        if self.database is not None:
            literal = f"'{value}'" if isinstance(value, str) else value
            self.spark.sql(f"ALTER TABLE {self.table(name)} DROP IF EXISTS PARTITION ({column} = {literal})")
        delete_path(self.spark, f"{self.path(name)}/{column}={value}")

    def read(self, name: str, years: list[int] | None = None, year_col: str = "crash_year") -> DataFrame:
        """Scan a table by name. ``years`` filters the partition column,
        so a table written with ``partition_by=[year_col]`` reads only
        those folders (partition pruning)."""
        if self.database is not None:
            df = self.spark.table(self.table(name))
        else:
            df = self.spark.read.format(self.fmt).load(self.path(name))
        if years is not None:
            df = df.filter(F.col(year_col).isin([int(y) for y in years]))
        return df

    def row_counts(self, names: list[str]) -> DataFrame:
        """One row per table: (table_name, row_count)."""
        parts = [self.read(n).agg(F.count(F.lit(1)).alias("row_count"))
                 .select(F.lit(n).alias("table_name"), "row_count") for n in names]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

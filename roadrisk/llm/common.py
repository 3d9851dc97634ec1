"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from roadrisk.sources.tables import delete_path, shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_folders: dict[str, SparkSession] = {}


@atexit.register
def remove_folders() -> None:
    """Delete the stored tables of this driver; their results have been written or read by then."""
    for folder, spark in _folders.items():
        with contextlib.suppress(Exception):  # the session may be gone
            delete_path(spark, folder)
    _folders.clear()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the cluster's shared checkpoint folder, kept until the
    driver ends (lazy results still read it) or ``remove_stored`` is called."""
    folder = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    _folders[folder] = spark
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it back. A lost
    executor then costs a re-read, not a recomputation."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_stored(df: DataFrame) -> None:
    """Delete the files behind a table made by ``stored`` that nothing reads any more."""
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        delete_path(df.sparkSession, folder)


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 * 2 ** 20


def ship_code(spark: SparkSession) -> None:
    """Prepare a session for the Python steps of this subpackage.

    Arrow batches are lowered (never raised) to ``BATCH_BYTES``: a batch exists
    several times at once, off the heap of the executor and in its Python workers.
    And this package is sent to the executors, once for each application, so that
    the workers can import it wherever the driver was started."""
    size = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", spark.conf.get(BATCH).strip().lower())
    if size is None or not 0 < int(size[1]) * 1024 ** " kmgtp".index(size[2] or " ") <= BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    context = spark.sparkContext
    if getattr(context, "_roadrisk_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='roadrisk-code-')}/roadrisk_code.zip"  # read by the driver alone
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    context.addPyFile(archive)
    context._roadrisk_shipped = True


def arrow_map(df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], Iterable[dict]]]) -> DataFrame:
    """``df.mapInArrow`` with the schema as DDL. ``make`` is called once per
    partition and returns a function from a batch to dictionaries of equally
    long columns; each becomes one output batch."""
    ship_code(df.sparkSession)
    struct = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(struct)

    def column(values, kind):
        return values.cast(kind) if isinstance(values, pa.Array) else pa.array(values, type=kind)

    def run(batches):
        work = make()
        for batch in batches:
            if batch.num_rows:
                for cols in work(batch):
                    yield pa.RecordBatch.from_arrays([column(cols[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, struct)


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as (src, dst) longs.

    Alternates the large-star and small-star steps until the edge set is a
    forest of stars. Minima are combined on the map side and joined back, so a
    node with very many neighbours is a skewed join key (which adaptive
    execution splits), never one group in one task. Every round is written to
    the shared folder; the round before it is deleted. Returns (node,
    component) for every node that has an edge, ``component`` being the
    smallest node of its component.
    """
    def directed(df: DataFrame) -> DataFrame:  # larger node first, no loops, no repeats
        return (df.filter(F.col("src") != F.col("dst"))
                .select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())

    def large_star(e: DataFrame) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        return e.select(F.col("v").alias("u"), F.col("u").alias("w")).join(low, "u").select(
            F.col("w").alias("src"), F.col("m").alias("dst"))

    def small_star(e: DataFrame) -> DataFrame:
        low = e.groupBy("u").agg(F.min("v").alias("m"))
        moved = e.join(low, "u").select(F.col("v").alias("src"), F.col("m").alias("dst"))
        return moved.unionByName(low.select(F.col("u").alias("src"), F.col("m").alias("dst")))

    def signature(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    now = stored(directed(edges), "edges")
    seen = signature(now)
    while True:
        half = stored(directed(large_star(now)), "edges")
        nxt = stored(directed(small_star(half)), "edges")
        sign = signature(nxt)
        remove_stored(half)
        remove_stored(now)
        now = nxt
        if sign == seen:
            break
        seen = sign
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionByName(stars.select(F.col("component").alias("node"), "component").distinct())

"""Atomic publishing of exports.

A publication is a folder ``versions/<id>`` with one file set per output and a manifest
that lists them. Readers find it through the file ``CURRENT``, which holds the id. A new
version is written whole beside the old ones; then ``CURRENT`` is replaced by one
atomic rename. So a reader sees the old version or the new one, never parts of both,
and a run that breaks before the rename leaves the old one published. ``Snapshot`` holds
on to the version it was opened on; the newest ``keep`` versions stay for such readers,
and what broken runs left is removed with the next publication.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from roadrisk.sources.tables import delete_path

Writer = Callable[[str], object]  # writes one output to the path it is given


class _Files:
    """Hadoop's file systems, as far as needed here."""

    def __init__(self, spark: SparkSession, root: str):
        jvm = spark._jvm
        self.spark, self.hadoop, self.conf = spark, jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
        self.fs = self.path(root).getFileSystem(self.conf)

    def path(self, p: str):
        return self.hadoop.Path(p)

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def names(self, folder: str) -> list[str]:
        return [s.getPath().getName() for s in self.fs.listStatus(self.path(folder))] if self.exists(folder) else []

    def files(self, folder: str) -> dict[str, int]:
        """Data files below a folder (or the file itself) with their sizes."""
        out, it = {}, self.fs.listFiles(self.path(folder), True)
        while it.hasNext():
            s = it.next()
            if not s.getPath().getName().startswith(("_", ".")):
                out[s.getPath().getName()] = s.getLen()
        return out

    def write(self, p: str, text: str) -> None:
        out = self.fs.create(self.path(p), True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def read(self, p: str) -> str:
        return "\n".join(r.value for r in self.spark.read.text(p).collect())

    def replace(self, source: str, target: str) -> None:
        """Rename over an existing file, in one step."""
        overwrite = getattr(self.hadoop, "Options$Rename").OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(getattr(self.hadoop, "Options$Rename"), 1)
        options[0] = overwrite
        context = self.hadoop.FileContext.getFileContext(self.fs.getUri(), self.conf)
        context.rename(self.fs.makeQualified(self.path(source)), self.fs.makeQualified(self.path(target)), options)


def publish(spark: SparkSession, root: str, outputs: dict[str, Writer], keep: int = 2) -> str:
    """Write all outputs as a new version and make it the current one. Returns its id."""
    if keep < 1:
        raise ValueError("keep at least the published version")
    files = _Files(spark, root)
    numbers = [int(v.partition("-")[0]) for v in files.names(f"{root}/versions")]
    version = f"{max(numbers, default=0) + 1:08d}-{uuid.uuid4().hex[:8]}"
    folder = f"{root}/versions/{version}"
    for name, write in outputs.items():
        write(f"{folder}/{name}")
    manifest = {"version": version, "outputs": {name: files.files(f"{folder}/{name}") for name in outputs}}
    files.write(f"{folder}/MANIFEST", json.dumps(manifest))
    files.write(f"{root}/CURRENT-{version}", version)
    files.replace(f"{root}/CURRENT-{version}", f"{root}/CURRENT")
    whole = sorted(v for v in files.names(f"{root}/versions") if files.exists(f"{root}/versions/{v}/MANIFEST"))
    for old in set(files.names(f"{root}/versions")) - set(whole[-keep:]) - {version}:
        delete_path(spark, f"{root}/versions/{old}")
    return version


class Snapshot:
    """One published version, whatever is published afterwards."""

    def __init__(self, spark: SparkSession, root: str, version: str | None = None):
        self.spark = spark
        files = _Files(spark, root)
        if version is None:
            if not files.exists(f"{root}/CURRENT"):
                raise FileNotFoundError(f"nothing is published under {root}")
            version = files.read(f"{root}/CURRENT").strip()
        self.version = version
        self.folder = f"{root}/versions/{version}"
        self.outputs: dict[str, dict[str, int]] = json.loads(files.read(f"{self.folder}/MANIFEST"))["outputs"]

    def path(self, name: str) -> str:
        if name not in self.outputs:
            raise KeyError(name)
        return f"{self.folder}/{name}"

    def json(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).json(self.path(name))

    def complete(self) -> bool:
        """Whether every file of the manifest is there with its size."""
        files = _Files(self.spark, self.folder)
        return all(files.files(f"{self.folder}/{name}") == sizes for name, sizes in self.outputs.items())

"""What a run of the job has finished, in the shared folder, so that a stopped run can go on."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fingerprint(spark: SparkSession, paths: Iterable[str]) -> str:
    """Names, sizes and times of all input files, in one number; their contents are not read."""
    parts = []
    for path in paths:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        one = F.xxhash64("path", "length", "modificationTime")
        parts.append(str(tuple(files.agg(F.count("*"), F.bit_xor(one), F.sum("length")).first())))
    return ";".join(parts)


class Manifest:
    """Markers in a folder, one for each finished piece of a run, and the tables it staged.

    A marker is written beside and renamed, so it is there whole or not at all; it is written after what
    it stands for. Facts are kept with it as JSON.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self.paths = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.paths(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def table(self, name: str) -> str:
        """Where the run stages a table."""
        return f"{self.folder}/tables/{name}"

    def facts(self, name: str) -> dict | None:
        """What was noted when ``name`` was finished; None where it was not."""
        marker = self.paths(f"{self.folder}/{name}.json")
        if not self.files.exists(marker):
            return None
        stream = self.files.open(marker)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def finish(self, name: str, **facts) -> dict:
        """Note that ``name`` is finished."""
        beside, marker = self.paths(f"{self.folder}/{name}.json.new"), self.paths(f"{self.folder}/{name}.json")
        stream = self.files.create(beside, True)
        stream.write(json.dumps(facts).encode())
        stream.close()
        self.files.delete(marker, False)
        if not self.files.rename(beside, marker):
            raise OSError(f"cannot write {self.folder}/{name}.json")
        return facts

    def begin(self, key: str) -> None:
        """Go on with the run of this key; what another key left is removed."""
        begun = self.facts("run")
        if begun is None or begun["key"] != key:
            self.clear()
            self.finish("run", key=key)

    def staged(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """A small table, computed and written by the first run that needs it."""
        if self.facts(f"table-{name}") is None:
            make().write.mode("overwrite").parquet(self.table(name))
            self.finish(f"table-{name}")
        return self.spark.read.parquet(self.table(name))

    def clear(self) -> None:
        self.files.delete(self.paths(self.folder), True)

"""Sets of tables that are replaced at once.

A run writes its tables into a folder of its own and, when all are there,
adds one small manifest that names the folder.  Readers take the newest
manifest, so a run that dies half-way leaves what they see untouched, and a
finished one replaces every table in the same moment.  Older folders, and
those of runs that never finished, are collected afterwards.

Everything goes through Hadoop's file system interface, so ``root`` may be
any address that Spark can read.  A manifest is written under a temporary
name and then renamed, which fails if the number is taken by another run.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from bibliospark.sources.tables import save_table

_MANIFESTS, _RUNS = "_manifests", "_runs"


class TableStore:
    """Versions of a set of tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.run = uuid.uuid4().hex
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- the run at hand ---

    def path(self, name: str) -> str:
        """Where this run keeps table ``name`` (which may have folders: ``p2/bridge``)."""
        return f"{self.root}/{_RUNS}/{self.run}/{name}"

    def write(self, name: str, df: DataFrame, fmt: str = "parquet") -> DataFrame:
        """Write one table of this run and read it back."""
        save_table(df, name, path=self.path(name), fmt=fmt)
        return self.spark.read.format(fmt).schema(df.schema).load(self.path(name))

    def commit(self) -> int:
        """Make this run's tables the current ones; returns the version's number."""
        number = max(self._numbers(), default=0) + 1
        folder = f"{self.root}/{_MANIFESTS}"
        self._fs.mkdirs(self._path(folder))
        draft, final = self._path(f"{folder}/_{self.run}"), self._path(f"{folder}/{number:012d}.json")
        out = self._fs.create(draft, True)
        out.write(json.dumps({"run": self.run}).encode())
        out.close()
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            self._fs.delete(draft, False)
            raise RuntimeError(f"another run has committed version {number} of {self.root}")
        return number

    # --- the current version ---

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.root}/{_MANIFESTS}")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))

    def _run_of(self, number: int) -> str:
        path = f"{self.root}/{_MANIFESTS}/{number:012d}.json"
        return json.loads(self.spark.read.text(path, wholetext=True).first()[0])["run"]

    def current(self, name: str = "") -> str:
        """The folder of the current version, or of its table ``name``."""
        numbers = self._numbers()
        if not numbers:
            raise FileNotFoundError(f"{self.root} holds no finished version")
        return f"{self.root}/{_RUNS}/{self._run_of(numbers[-1])}" + (f"/{name}" if name else "")

    def read(self, name: str, fmt: str = "parquet") -> DataFrame:
        return self.spark.read.format(fmt).load(self.current(name))

    # --- what is left behind ---

    def collect(self, keep: int = 1) -> list[str]:
        """Delete all but the ``keep`` newest versions, and folders of runs that never finished.

        Not for use beside a run that is still writing, whose folder would
        look unfinished (this object's own run is spared)."""
        numbers = self._numbers()
        kept = {self._run_of(n) for n in numbers[-keep:]} | {self.run}
        for n in numbers[:-keep]:
            self._fs.delete(self._path(f"{self.root}/{_MANIFESTS}/{n:012d}.json"), False)
        runs = self._path(f"{self.root}/{_RUNS}")
        found = [s.getPath().getName() for s in self._fs.listStatus(runs)] if self._fs.exists(runs) else []
        gone = sorted(r for r in found if r not in kept)
        for r in gone:
            self._fs.delete(self._path(f"{self.root}/{_RUNS}/{r}"), True)
        return gone

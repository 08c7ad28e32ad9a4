"""Publication of a run's outputs in two steps (K1, K2, K5): stage, then commit.

A run writes everything into a folder of its own, ``<out>/runs/<run>``, and counts the rows of each output
while it writes. The commit is one small file, ``<out>/commits/<number>.json``, that names the run and its
outputs with their row counts; readers follow the last complete one (``current``). A run that is stopped
anywhere before leaves the former outputs as they were, whole and found; one stopped while it writes the
commit file leaves an incomplete file, which counts for nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class Folder:
    """The few calls on a folder that publishing makes, on any file system of the session."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def at(self, name: str):
        return self._path(f"{self.root}/{name}")

    def numbers(self, name: str) -> list[int]:
        """Numbers of the files ``<number>.json`` in a subfolder, in order."""
        if not self._fs.exists(self.at(name)):
            return []
        stems = [s.getPath().getName().removesuffix(".json") for s in self._fs.listStatus(self.at(name))]
        return sorted(int(s) for s in stems if s.isdigit())

    def names(self, name: str) -> list[str]:
        return [s.getPath().getName() for s in self._fs.listStatus(self.at(name))] if self._fs.exists(self.at(name)) else []

    def write(self, name: str, text: str) -> None:
        """A new file; fails if there is one of that name."""
        out = self._fs.create(self.at(name), False)
        out.write(bytearray(text.encode()))
        out.close()

    def delete(self, name: str) -> None:
        self._fs.delete(self.at(name), True)


def commits(spark: SparkSession, out: str) -> list[dict]:
    """The complete commits, oldest first: run, outputs (name -> rows or null)."""
    folder, found = Folder(spark, out), []
    for n in folder.numbers("commits"):
        row = spark.read.text(f"{folder.root}/commits/{n}.json", wholetext=True).first()
        try:
            found.append(json.loads(row[0]) | {"number": n})
        except (TypeError, ValueError):  # stopped while it was written
            continue
    return found


def current(spark: SparkSession, out: str) -> str | None:
    """The folder of the last committed run, or None."""
    done = commits(spark, out)
    return f"{out.rstrip('/')}/runs/{done[-1]['run']}" if done else None


class Publication:
    """One run's outputs. ``keep`` former runs stay, for readers that are still at them."""

    def __init__(self, spark: SparkSession, out: str, keep: int = 1):
        self.folder, self.keep, self.run = Folder(spark, out), keep, uuid.uuid4().hex
        self.base = f"{self.folder.root}/runs/{self.run}"
        self.rows: dict[str, int | None] = {}
        self._seen: dict[str, Observation] = {}

    def counted(self, name: str, df: DataFrame, *metrics: Column) -> tuple[DataFrame, Observation]:
        """``df`` with its rows (and ``metrics``) counted by the job that writes it."""
        seen = self._seen[name] = Observation(f"{name}-{self.run}")
        return df.observe(seen, F.count(F.lit(1)).alias("rows"), *metrics), seen

    def parquet(self, name: str, df: DataFrame) -> str:
        """Stage a table; returns its path."""
        counted, _ = self.counted(name, df)
        counted.write.parquet(f"{self.base}/{name}")
        return f"{self.base}/{name}"

    def add(self, name: str, rows: int | None = None) -> None:
        """An output that was written into ``base`` otherwise."""
        self.rows[name] = rows

    def commit(self, more: dict | None = None) -> dict:
        """Make the run the current one; returns the manifest, which holds ``more`` as well."""
        outputs = {**self.rows, **{n: int(o.get["rows"]) for n, o in self._seen.items()}}
        manifest = {"run": self.run, "outputs": outputs, **(more or {})}
        number = max(self.folder.numbers("commits"), default=0) + 1
        self.folder.write(f"commits/{number}.json", json.dumps(manifest))
        stay = {c["run"] for c in commits(self.folder.spark, self.folder.root)[-1 - self.keep :]}
        for name in self.folder.names("runs"):
            if name not in stay:
                self.folder.delete(f"runs/{name}")
        return manifest

    def abandon(self) -> None:
        """Delete what was staged."""
        self.folder.delete(f"runs/{self.run}")

"""Tables written to cut lineage, in the folder that all executors share.

``spark.checkpoint.dir`` names that folder; only where it is unset and the session is local (tests, a laptop) a temporary
folder is taken and set. A written table survives the loss of executors, is columnar and compressed, and can be deleted
when superseded.
"""

from __future__ import annotations

import atexit
import json
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The folder named by the session; a temporary one is set where there is none, in a local session only: on a cluster
    a folder of one machine would not be seen by the others."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="roadloom-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def _delete(spark: SparkSession, at: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Named tables of one run. ``drop`` deletes a superseded one; what is left goes when the session's process ends,
    since a returned DataFrame may still read it."""

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        atexit.register(self.close)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, name: str) -> None:
        _delete(self.spark, self.path(name))

    def close(self) -> None:
        try:
            _delete(self.spark, self.root)
        except Exception:  # the session has ended; its folder is no longer ours to reach
            pass


class Tables:
    """State that lasts: tables of named parts, each in folders by bucket, and commits that say which parts count."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _fs(self, at: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(at)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _list(self, at: str) -> list[str]:
        fs, path = self._fs(at)
        return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []

    def write(self, df: DataFrame, table: str, name: str) -> None:
        """Writes a part by its column ``bucket``."""
        df.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.root}/{table}/{name}")

    def save(self, df: DataFrame, table: str, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.root}/{table}/{name}")

    def buckets(self, table: str, name: str) -> set[int]:
        """The buckets that a part has rows in, by its folders."""
        return {int(f.split("=")[1]) for f in self._list(f"{self.root}/{table}/{name}") if f.startswith("bucket=")}

    def read(self, schema: str | T.StructType, table: str, name: str, buckets: set[int] | None = None) -> DataFrame:
        """A part, or those of its buckets that are wanted: no other folder is opened."""
        at = f"{self.root}/{table}/{name}"
        paths = [at] if buckets is None else [f"{at}/bucket={b}" for b in sorted(self.buckets(table, name) & buckets)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(*paths)
        return df.drop("bucket")

    def drop(self, table: str, name: str) -> None:
        _delete(self.spark, f"{self.root}/{table}/{name}")

    def commit(self, step: int, state: dict) -> None:
        """Makes a step count: its file takes its name only once it is whole."""
        fs, path = self._fs(f"{self.root}/commits/{step:09d}.json")
        _, draft = self._fs(f"{self.root}/commits/.draft")
        out = fs.create(draft, True)
        out.write(bytearray(json.dumps(state).encode()))
        out.close()
        fs.delete(path, False)
        if not fs.rename(draft, path):
            raise OSError(f"could not commit {path}")

    def committed(self) -> dict:
        """The state of the last step that counts; empty before the first."""
        names = sorted(n for n in self._list(f"{self.root}/commits") if n.endswith(".json") and not n.startswith("."))
        if not names:
            return {}
        fs, path = self._fs(f"{self.root}/commits/{names[-1]}")
        source = fs.open(path)
        text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        source.close()
        return json.loads(text)

"""Shared intermediate tables, size checks and small helpers of the training-data operators."""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid
import weakref
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_OWN: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where that is unset, a temporary folder serves a local
    session (tests); on a cluster it must be set."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.sparkContext.applicationId
        at = _OWN.setdefault(app, "") or "file://" + tempfile.mkdtemp(prefix="locusloom-")
        _OWN[app] = at
    return at.rstrip("/")


class Scratch:
    """Tables written to the shared folder to cut lineage; a lost executor costs no more than a reread.

    They go when the session's process ends, or earlier with :meth:`drop` and :meth:`release`.
    """

    _live: weakref.WeakSet = weakref.WeakSet()

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        Scratch._live.add(self)
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        self.names: list[str] = []
        atexit.register(self._remove, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def cut(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back."""
        self.names.append(name)
        df.write.mode("overwrite").option("compression", "zstd").parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Remove tables that no later step reads."""
        for name in names:
            self._remove(self.path(name))

    def release(self, *kept: str) -> None:
        """Remove all tables but ``kept``, and let Spark delete the shuffle files of frames that are no longer held."""
        for name in set(self.names).difference(kept):
            self._remove(self.path(name))
        self.names = list(kept)
        self.sweep()

    @contextmanager
    def alone(self):
        """Remove the tables of all operators that are called inside, when the block ends: only this one's stay."""
        before = set(Scratch._live)
        yield
        for other in set(Scratch._live) - before - {self}:
            for name in other.names:
                other._remove(other.path(name))
            other.names = []
        self.sweep()

    def sweep(self) -> None:
        """Let Spark delete the shuffle files of frames that are no longer held, once their results are written."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def _remove(self, path: str) -> None:
        try:
            jvm = self.spark.sparkContext._jvm
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # the session has ended: nothing left to ask
            pass


def if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows (counted now), else as it is: Spark then
    shuffles both sides and splits skewed partitions. ``df`` should be cheap to count, such as a written table."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def crc_mod(col: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null ids count as empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


def text_of(col: str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce(F.col(col), F.lit(""))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")

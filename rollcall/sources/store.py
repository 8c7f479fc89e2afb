"""Durable intermediate tables.

A table that several plans read is written once and read back, which cuts lineage, survives
lost executors and still prunes columns. The folder comes from `spark.checkpoint.dir`; only a
local session without that setting gets a folder of its own. What a run leaves goes when its JVM ends.

A `TableStore` belongs to one run. The `SessionStore` is shared by all runs of a session: a table that one of them has
written is read by the others, as long as it is the same plan over the same files.
"""

from __future__ import annotations

import atexit
import hashlib
import math
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


#: Input rows for each task after a shuffle. While the widest rows are sorted and merged, each takes about 2 KB.
ROWS_PER_TASK = 200_000
#: Shuffled bytes up to which adaptive execution puts small partitions together. The rows compress to a fortieth of what
#: they take in memory, so the 64 MB it allows by default come to gigabytes in a task.
JOINED_BYTES = "8m"

#: The folder of each local session that has no setting.
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local") or context.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _OWN:
        _OWN[context.applicationId] = tempfile.mkdtemp(prefix="rollcall-")
    return _OWN[context.applicationId]


def tasks_for(spark: SparkSession, rows: int) -> int:
    """Shuffle tasks for so many input rows, never fewer than the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / ROWS_PER_TASK))


@contextmanager
def sized(spark: SparkSession, rows: int) -> Iterator[None]:
    """Plans that start within have shuffle tasks by their input rows; the session's own settings come back after it.

    Inputs that the session's number of tasks is enough for run under its own settings.
    """
    tasks, own = tasks_for(spark, rows), spark.conf.get("spark.sql.shuffle.partitions")
    if tasks == int(own):
        yield
        return
    joined = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(joined, None)
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    spark.conf.set(joined, JOINED_BYTES)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", own)
        if before is None:
            spark.conf.unset(joined)
        else:
            spark.conf.set(joined, before)


@contextmanager
def released(spark: SparkSession) -> Iterator[None]:
    """Tables written within leave no shuffle files behind: nothing reads those again once a table stands.

    Without it they stay until the JVM happens to collect the plan, those of all tables written so far beside each other.
    """
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class TableStore:
    """Parquet tables of one run below the shared folder."""

    def __init__(self, spark: SparkSession, folder: str | None = None) -> None:
        self._spark = spark
        self.root = f"{folder or shared_folder(spark)}/rollcall/{uuid.uuid4().hex}"
        path = spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)

    def put(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = f"{self.root}/{name}"
        with released(self._spark):
            df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
        return self._spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Delete every table of this run."""
        jvm = self._spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(path, True)


class SessionStore(TableStore):
    """Tables that all plans of a session share.

    A table is known by its name, its plan and its input files. Plans are compared by Spark as a whole, so any setting
    that enters them tells tables apart. Files are compared by their paths and total size: what Spark writes has new
    names each time, whereas a file replaced in place by one of the same size is not noticed.
    """

    def __init__(self, spark: SparkSession) -> None:
        super().__init__(spark)
        self._held: dict[str, list[tuple[DataFrame, str, DataFrame]]] = {}
        self.written = 0

    @staticmethod
    def of(spark: SparkSession) -> SessionStore:
        """The store of a session; it is emptied when Python ends or the session is asked to `drop` it."""
        application = spark.sparkContext.applicationId
        if application not in _SHARED:
            _SHARED[application] = SessionStore(spark)
            atexit.register(_drop_if_alive, application)
        return _SHARED[application]

    def put(self, name: str, df: DataFrame, partition_by: tuple[str, ...] = ()) -> DataFrame:
        files = _inputs(df)
        for plan, of, stored in self._held.get(name, ()):
            if of == files and plan.sameSemantics(df):
                return stored
        self.written += 1
        stored = super().put(f"{name}-{self.written}", df, partition_by)
        self._held.setdefault(name, []).append((df, files, stored))
        return stored

    def drop(self) -> None:
        self._held.clear()
        super().drop()


_SHARED: dict[str, SessionStore] = {}


def _drop_if_alive(application: str) -> None:
    store = _SHARED.pop(application)
    if store._spark.sparkContext._jsc is not None:
        store.drop()


def _inputs(df: DataFrame) -> str:
    """A digest of the files a plan reads and of their size."""
    size = str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return hashlib.sha256("\n".join([size, *sorted(df.inputFiles())]).encode()).hexdigest()

"""Tables written mid-query to the folder every executor shares.

Reading a written table back cuts the lineage and keeps column pruning and
size statistics. A lost executor then costs only the work since the last write.
"""

import itertools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_folder: tempfile.TemporaryDirectory | None = None
_proven: set[tuple[str, str]] = set()


def _one_machine(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def _names_a_store(folder: str) -> bool:
    return "://" in folder and not folder.startswith("file:")


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only in local mode.

    On a cluster of several machines the folder must be one that all of them see.
    YARN has a shared store of its own, so a path without a scheme or with
    ``file:`` is refused there. Standalone and Kubernetes clusters share folders
    by mounts as well: such a path is taken, and put to the proof before the
    first table is written, see ``prove_shared``. The ``local`` and
    ``local-cluster`` masters run on one machine and may use either.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if folder and (_names_a_store(folder) or not master.startswith("yarn")):
        return folder.rstrip("/")
    if folder:
        raise ValueError(f"spark.checkpoint.dir is {folder}, which other machines do not see; name a shared store")
    if not master.startswith("local[") and master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="admesh-")
    return _local_folder.name


def prove_shared(spark: SparkSession, path: str) -> None:
    """Fail unless what the executors write to ``path`` is seen by the driver and read again.

    Executors that each write to a disk of their own would otherwise leave tables
    empty or cut, without an error from Spark. Every core gets several tasks of
    one row; an executor that joins later is not looked at.
    """
    tasks = 4 * spark.sparkContext.defaultParallelism
    spark.range(0, tasks, 1, tasks).write.parquet(path)
    seen = spark.read.schema("id bigint").parquet(path).count()
    if seen != tasks:
        raise ValueError(f"spark.checkpoint.dir is not shared: of {tasks} rows that executors wrote to {path}, {seen} are seen")


class RunFolder:
    """A folder of its own for the tables of one run, deleted at the latest when the JVM ends.

    Spark has no public call that deletes files, so this uses the Hadoop file
    system of a classic session. Over Spark Connect the folder stays until it is
    deleted by other means.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.parent = shared_folder(spark)
        self.path = f"{self.parent}/admesh-{uuid.uuid4().hex}"
        self._numbers = itertools.count()

    def _files(self):
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()), path

    def _prove(self) -> None:
        """Once for each session and folder, where its name does not tell that all machines see it."""
        if _one_machine(self.spark) or _names_a_store(self.parent):
            return
        key = self.spark.sparkContext.applicationId, self.parent
        if key not in _proven:
            prove_shared(self.spark, f"{self.path}/proof")
            _proven.add(key)

    def place(self, name: str) -> str:
        """A new path of this run, deleted with its tables."""
        number = next(self._numbers)
        if number == 0 and hasattr(self.spark, "_jvm"):
            files, folder = self._files()
            files.mkdirs(folder)
            files.deleteOnExit(folder)
        if number == 0:
            self._prove()
        return f"{self.path}/{name}-{number}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as a new table of this run and return a scan of it."""
        path = self.place(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        """Delete this run's tables. DataFrames that scan them stop working."""
        files, path = self._files()
        files.delete(path, True)

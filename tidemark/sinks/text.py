"""CSV exports: a folder of parts, or one file where the caller asks for one."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators.counts import observed
from tidemark.session import scratch_path
from tidemark.sinks.partitions import WriteReport
from tidemark.specs import DestSpec


def export_csv(df: DataFrame, dest: DestSpec) -> WriteReport:
    """Writes ``df`` below ``dest.path``, in one job.

    The destination alone decides the layout, never the number of rows. All tasks write
    parts. With ``single`` these become the file ``file_name``, in the order of the frame's
    partitions and under one header; otherwise they stay a folder of that name, if one is
    given.
    """
    target = f"{dest.path}/{dest.file_name}" if dest.file_name else dest.path
    counted, observation = observed(df)
    if not dest.single:
        _csv(counted, target, dest.header)
        return WriteReport(target, observation.get["rows"])
    if not dest.file_name:
        raise ValueError("a single file needs a file_name")
    spark = df.sparkSession
    staging = scratch_path(spark, "export")
    files = _Files(spark, dest.path)
    try:
        _csv(counted, f"{staging}/parts", False)
        heads = []
        if dest.header:
            _csv(spark.createDataFrame([], df.schema).coalesce(1), f"{staging}/head", True)
            heads = files.parts(f"{staging}/head")
        files.join([*heads, *files.parts(f"{staging}/parts")], target)
    finally:
        files.remove(staging)
    return WriteReport(target, observation.get["rows"])


def _csv(df: DataFrame, path: str, header: bool) -> None:
    df.write.mode("overwrite").option("header", str(header).lower()).csv(path)


class _Files:
    """File operations on the stores that hold the paths."""

    def __init__(self, spark, path: str):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()
        at, store = self._open(path)
        store.mkdirs(at)

    def _open(self, path: str):
        at = self._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self._conf)

    def remove(self, path: str) -> None:
        at, store = self._open(path)
        store.delete(at, True)

    def parts(self, folder: str) -> list[str]:
        """Data files of a written folder, in the order of their partitions."""
        at, store = self._open(f"{folder}/part-*")
        return sorted(f.getPath().toString() for f in store.globStatus(at))

    def join(self, parts: list[str], target: str) -> None:
        """The parts one after the other, copied through a small buffer into a file that
        takes the target's place once it is complete."""
        hidden, store = self._open(f"{target}._joining")
        goal, _ = self._open(target)
        out = store.create(hidden, True)
        try:
            for part in parts:
                at, source = self._open(part)
                data = source.open(at)
                try:
                    self._jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, self._conf, False)
                finally:
                    data.close()
        finally:
            out.close()
        store.delete(goal, True)
        if not store.rename(hidden, goal):
            raise OSError(f"cannot move the joined file to {target}")

"""Tables that a stream appends to: a folder per month, run and micro-batch.

A run is what one checkpoint stands for; its id is kept with the checkpoint. A batch looks at
the months of its own rows only, there at everything but its own folders, and writes those as
a whole. So a batch that is run again gives the same rows and adds nothing twice, also if it
now has none. A new checkpoint is a new run and cannot touch what earlier ones wrote.

Old folders are folded: once a month has more than ``FOLDERS`` of one level they become one
folder of the next, so their number grows with the logarithm of the batches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.manifest import partition_folder

RUN, BATCH, MONTH = "run_id", "batch_id", "data_referencia"
PLACE = (RUN, BATCH)
FOLDERS = 16
FOLDED = "folded-"
INTENTS = "_folding"


def with_place(schema: T.StructType) -> T.StructType:
    own = [f for f in schema if f.name not in PLACE]
    return T.StructType([*own, T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())])


class _Store:
    """Folders of the store that holds ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.files = self.at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def at(self, below: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{below}" if below else self.root)

    def exists(self, below: str) -> bool:
        return self.files.exists(self.at(below))

    def folders(self, below: str) -> list[str]:
        at = self.at(below)
        return sorted(s.getPath().getName() for s in self.files.listStatus(at) if s.isDirectory()) if self.files.exists(at) else []

    def matching(self, pattern: str) -> list:
        return [s.getPath() for s in self.files.globStatus(self.at(pattern)) or []]

    def remove(self, below: str) -> None:
        self.files.delete(self.at(below), True)

    def move(self, below: str, to: str) -> None:
        self.files.mkdirs(self.at(to).getParent())
        if not self.files.rename(self.at(below), self.at(to)):
            raise OSError(f"cannot move {below} to {to} in {self.root}")

    def write(self, below: str, text: str) -> None:
        out = self.files.create(self.at(below), True)
        out.write(bytearray(text.encode()))
        out.close()

    def read(self, path) -> str:
        data = self.files.open(path)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(data, "UTF-8")
        finally:
            data.close()


def create_folder(spark: SparkSession, path: str) -> None:
    """An empty table, so that the first batch finds one."""
    store = _Store(spark, path)
    store.files.mkdirs(store.at(""))


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark keeps in the checkpoint, the same after every restart from it."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def months_of(df: DataFrame) -> list[str | None]:
    """The months of a batch: as many as the calendar has, not as there are rows."""
    return [r[0] for r in df.select(MONTH).distinct().collect()]


def _of_month(month: str | None) -> str:
    return partition_folder({MONTH: month})


def in_months(months: Sequence[str | None]) -> Column:
    named = [m for m in months if m is not None]
    found = F.col(MONTH).isin(*named) if named else F.lit(False)
    return found | F.col(MONTH).isNull() if None in months else found


def other_batches(
    spark: SparkSession, path: str, schema: T.StructType, run: str, batch_id: int, months: Sequence[str | None]
) -> DataFrame:
    """Rows of these months from all batches but this one. Other months are not even listed."""
    store = _Store(spark, path)
    there = [_of_month(m) for m in months if store.exists(_of_month(m))]
    if not there:
        return spark.createDataFrame([], with_place(schema))
    reader = spark.read.schema(with_place(schema)).option("basePath", path)
    rows = reader.parquet(*[f"{path}/{f}" for f in there]).where(in_months(months))
    return rows.where((F.col(RUN) != run) | (F.col(BATCH) != batch_id))


def write_batch(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    """The batch's rows in place of all that it wrote before, in whichever month."""
    store = _Store(df.sparkSession, path)
    for folder in store.matching(f"*/{RUN}={run}/{BATCH}={batch_id}"):
        store.files.delete(folder, True)
    placed = df.drop(*PLACE).withColumns({RUN: F.lit(run), BATCH: F.lit(batch_id).cast("long")})
    placed.write.mode("append").partitionBy(MONTH, *PLACE).parquet(path)


def _level(run: str) -> int:
    return int(run.removeprefix(FOLDED)) if run.startswith(FOLDED) else 0


def finish_folds(spark: SparkSession, path: str) -> None:
    """Ends folds that were cut short: those that had been put in place lose their old
    folders, others leave no trace."""
    store = _Store(spark, path)
    for note in store.matching(f"{INTENTS}/*.json"):
        intent = json.loads(store.read(note))
        if store.exists(intent["from"]):
            store.remove(intent["from"])
        else:
            for old in intent["old"]:
                store.remove(old)
        store.files.delete(note, False)


def fold_batches(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    run: str,
    batch_id: int,
    months: Sequence[str | None],
    merge: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    most: int = FOLDERS,
) -> None:
    """Folds months of this batch that have more than ``most`` folders of one level. The
    batch's own folders are left alone, as it may have to run again.

    The folded rows are written aside, a note names the folders they replace, then they take
    their place. A reader in the moment between that and the removal of the old folders may
    see rows twice; after a crash the next batch removes them before it reads.
    """
    store = _Store(spark, path)
    for month in months:
        home = _of_month(month)
        levels: dict[int, list[str]] = {}
        for runs in store.folders(home):
            own = runs.removeprefix(f"{RUN}=")
            for batch in store.folders(f"{home}/{runs}"):
                if (own, batch) != (run, f"{BATCH}={batch_id}"):
                    levels.setdefault(_level(own), []).append(f"{home}/{runs}/{batch}")
        for level, folders in sorted(levels.items()):
            if len(folders) <= most:
                continue
            name = uuid.uuid4().hex
            number = 1 + max((int(f.rsplit("=", 1)[1]) for f in levels.get(level + 1, [])), default=0)
            aside, goal = f"{INTENTS}/{name}", f"{home}/{RUN}={FOLDED}{level + 1}/{BATCH}={number}"
            own = T.StructType([f for f in schema if f.name not in (*PLACE, MONTH)])
            rows = spark.read.schema(own).parquet(*[f"{path}/{f}" for f in folders])
            merge(rows).write.parquet(f"{path}/{aside}")
            store.write(f"{INTENTS}/{name}.json", json.dumps({"from": aside, "old": folders}))
            store.move(aside, goal)
            finish_folds(spark, path)

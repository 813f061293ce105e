"""Tables of documents: frames given by the caller, Parquet folders, and stores that take writes.

A store keeps a base and small deltas: rows that replace or delete rows of the base, by id. A commit adds one delta and
one log entry. The entry is written whole under another name and then takes its own, which fails if that is taken: of two
writers that started from one state only one commits, and no reader sees half an entry. Folders on HDFS and on local disks
can do that; an object store needs a committer that puts only if absent.

Reading joins the deltas' ids against the base. Writers never rewrite the table: `compact` folds deltas (all into the
base, or with `deltas_only` into one delta, at the cost of the recent writes alone), `clean` removes what old commits left.
Both are maintenance, run apart from writers.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.shape import fit

class Conflict(Exception):
    """Another writer committed first."""


class Store:
    """Versions of one table below a folder."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, key: str):
        self.spark, self.path, self.schema, self.key = spark, path.rstrip("/"), schema, key
        jvm = spark._jvm
        self._folder = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_log")
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._folder)

    def _entry(self, n: int):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_log/{n:012d}.json")

    def _numbers(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._folder)]
        return sorted(int(x[:12]) for x in names if x.endswith(".json") and x[:12].isdigit())

    def version(self) -> int:
        """The number of the last commit, 0 before the first."""
        return max([0, *self._numbers()])

    def state(self, n: int) -> dict:
        """Base and deltas as of commit n. An entry that cannot be read never became a commit: the one before it counts."""
        for k in sorted((x for x in self._numbers() if x <= n), reverse=True):
            stream = self._fs.open(self._entry(k))
            try:
                state = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
            except ValueError:
                continue
            finally:
                stream.close()
            if isinstance(state, dict) and {"base", "deltas"} <= state.keys():
                return state
        return {"base": None, "deltas": []}

    def _commit(self, n: int, state: dict) -> None:
        """Log state as commit n + 1; Conflict if there is one already, any other failure as it is."""
        jvm, entry = self.spark._jvm, self._entry(n + 1)
        draft = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_log/draft-{uuid.uuid4().hex}")
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps(state).encode()))
        finally:
            out.close()
        try:
            if self._fs.getScheme() == "file":  # a rename would overwrite here, a link does not
                os.link(draft.toUri().getPath(), entry.toUri().getPath())
            else:
                options = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
                jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._folder.toUri(), self.spark._jsc.hadoopConfiguration()).rename(draft, entry, options)
        except FileExistsError as e:
            raise Conflict(str(n + 1)) from e
        except Py4JJavaError as e:
            if "FileAlreadyExistsException" in e.java_exception.getClass().getName():
                raise Conflict(str(n + 1)) from e
            raise
        finally:
            self._fs.delete(draft, False)

    def read(self, n: int | None = None) -> DataFrame:
        """The rows as of commit n, by default the last."""
        state = self.state(self.version() if n is None else n)
        base = self.spark.read.schema(self.schema).parquet(state["base"]) if state["base"] else self.spark.createDataFrame([], self.schema)
        if not state["deltas"]:
            return base
        newest = self._newest(state["deltas"])
        kept = base.join(newest.select(F.col(self.key).alias("_changed")), F.col(f"`{self.key}`") == F.col("_changed"), "left_anti")
        return kept.unionByName(newest.filter("not _gone").select(*(f"`{c}`" for c in self.schema.names)))

    def replace(self, rows: DataFrame, n: int | None = None) -> int:
        """Make rows the whole table, if commit n is still the last."""
        n = self.version() if n is None else n
        path = f"{self.path}/base-{uuid.uuid4().hex}"
        self.shaped(rows).write.parquet(path)
        self._commit(n, {"base": path, "deltas": []})
        return n + 1

    def change(self, upserts: DataFrame | None, deleted: DataFrame | None, n: int) -> int:
        """Put rows by id and delete ids, if commit n is still the last."""
        parts = []
        if upserts is not None:
            parts.append(self.shaped(upserts).withColumns({"_gone": F.lit(False), "_seq": F.lit(n + 1).cast("bigint")}))
        if deleted is not None:
            kind = self.schema[self.key].dataType
            empty = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != self.key else F.col(f"`{self.key}`").cast(kind).alias(self.key) for f in self.schema.fields]
            parts.append(deleted.select(*empty).withColumns({"_gone": F.lit(True), "_seq": F.lit(n + 1).cast("bigint")}))
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        path = f"{self.path}/delta-{uuid.uuid4().hex}"
        rows.write.parquet(path)
        state = self.state(n)
        self._commit(n, {"base": state["base"], "deltas": [*state["deltas"], path]})
        return n + 1

    def delta(self, n: int) -> DataFrame:
        """The rows that commit n put."""
        rows = self.spark.read.schema(self._wide()).parquet(self.state(n)["deltas"][-1])
        return rows.filter("not _gone").select(*(f"`{c}`" for c in self.schema.names))

    def _wide(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("_gone", T.BooleanType()), T.StructField("_seq", T.LongType())])

    def _newest(self, deltas: list[str]) -> DataFrame:
        """The last change of each id."""
        changes = self.spark.read.schema(self._wide()).parquet(*deltas)
        return changes.withColumn("_rn", F.row_number().over(Window.partitionBy(self.key).orderBy(F.desc("_seq")))).filter("_rn = 1").drop("_rn")

    def compact(self, deltas_only: bool = False) -> None:
        """Fold the deltas into a new base, or into one delta; another writer's commit meanwhile leaves them as they are."""
        n = self.version()
        state = self.state(n)
        try:
            if not deltas_only:
                self.replace(self.read(n), n)
            elif len(state["deltas"]) > 1:
                path = f"{self.path}/delta-{uuid.uuid4().hex}"
                self._newest(state["deltas"]).write.parquet(path)
                self._commit(n, {"base": state["base"], "deltas": [path]})
        except Conflict:
            pass

    def clean(self, keep: int = 10, older_than: float = 24 * 3600) -> None:
        """Remove log entries but the last `keep`, and bases and deltas that those do not name.

        Folders younger than `older_than` seconds stay: a writer may be about to commit them.
        """
        numbers = self._numbers()
        named = {x.rpartition("/")[2] for n in numbers[-keep:] for s in [self.state(n)] for x in [s["base"], *s["deltas"]] if x}
        for n in numbers[:-keep]:
            self._fs.delete(self._entry(n), False)
        now = self.spark._jvm.java.lang.System.currentTimeMillis()
        for s in self._fs.listStatus(self._folder.getParent()):
            name = s.getPath().getName()
            if name.startswith(("base-", "delta-")) and name not in named and now - s.getModificationTime() >= older_than * 1000:
                self._fs.delete(s.getPath(), True)

    def shaped(self, rows: DataFrame) -> DataFrame:
        """The store's columns in their types; absent ones are null, unknown ones go."""
        have = {f.name: f.dataType for f in rows.schema.fields}
        return rows.select(*((fit(F.col(f"`{f.name}`"), have[f.name], f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in self.schema.fields))


class Tables:
    """Frames by name: given ones, or stores below a root folder once a name has been written."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, root
        self._frames: dict[str, Callable[[], DataFrame]] = {}
        self._stores: dict[str, Store] = {}

    def put(self, name: str, frame: DataFrame | Callable[[], DataFrame]) -> None:
        self._frames[name] = (lambda: frame) if isinstance(frame, DataFrame) else frame

    def has(self, name: str) -> bool:
        return name in self._stores or name in self._frames

    def read(self, name: str) -> DataFrame:
        if name in self._stores:
            return self._stores[name].read()
        return self._frames[name]()

    def store(self, name: str, schema: T.StructType, key: str) -> Store:
        """The store of a name; a given frame becomes its first base."""
        if name not in self._stores:
            if self.root is None:
                raise ValueError("writes need a root folder")
            s = Store(self.spark, f"{self.root.rstrip('/')}/{name}", schema, key)
            if s.version() == 0 and name in self._frames:
                try:
                    s.replace(self._frames[name](), 0)
                except Conflict:  # another first writer was faster; its base is as good
                    pass
            self._stores[name] = s
        return self._stores[name]


def parquet_dir(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table `name` of a folder; NaN in a floating column reads as null."""
    frame = spark.read.parquet(f"{folder}/{name}.parquet")
    return without_nan(frame)


def without_nan(frame: DataFrame) -> DataFrame:
    """NaN equals nothing, so it is null here. Only columns that hold floating numbers are touched."""
    floating = [f.name for f in frame.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return frame.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating}) if floating else frame

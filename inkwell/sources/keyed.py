"""Tables whose rows have keys: writes that may come twice, or two at once.

A write lays its files beside the others and counts only once the log names it,
so a write that fails, or comes again, changes nothing or the same:

    root/data/w=W/<partitions>/...   the rows of one write
    root/gone/w=W/...                keys of earlier writes' rows that it takes the place of
    root/log/NNNNNNNN.json           what write number N did; a number is given once

`merge` keeps earlier rows but those of the same key: it reads the keys, and
only the keys, of the partitions that it touches. `rebuild` writes its
partitions anew. Readers take the writes that the log names, without the
partitions rebuilt since and without rows taken the place of; these are few,
and none where no write repeats a key. `compact` rebuilds partitions as they
are, so that neither writes nor replaced rows heap up.

The driver holds one row a write and partition, never rows of the table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_LOG = "n long, w string, mode string, gone boolean, parts array<array<string>>"


@dataclass(frozen=True)
class Keyed:
    """root; schema of the columns beside the partitions; partitions (strings, never null or empty); key, beside them; form of the files."""

    root: str
    schema: str
    by: tuple[str, ...]
    key: tuple[str, ...]
    form: str = "parquet"

    # --- reading

    def read(self, spark: SparkSession, **where: str | list[str]) -> DataFrame:
        """The table, or the partitions whose columns have the given values: schema, partitions, and each row's write (w), file and the file's time (file, mtime)."""
        return self._read(spark, self._log(spark), where)

    def _log(self, spark: SparkSession) -> list:
        """What the writes did, in order. A file without a row is a write that broke off while it was named."""
        try:
            return sorted(spark.read.schema(_LOG).json(f"{self.root}/log").where("w is not null").collect(), key=lambda r: r["n"])
        except AnalysisException:  # no such path
            return []

    def _read(self, spark: SparkSession, log: list, where: dict, columns: str | None = None) -> DataFrame:
        wanted = {c: {v} if isinstance(v, str) else set(v) for c, v in where.items()}
        fits = lambda part: all(part[self.by.index(c)] in values for c, values in wanted.items())
        live: dict[tuple, list[str]] = {}  # partition -> writes
        for entry in log:
            for part in map(tuple, entry["parts"]):
                if fits(part):
                    live[part] = [entry["w"], *(live.get(part, []) if entry["mode"] == "merge" else [])]
        of_write: dict[str, list[tuple]] = {}
        for part, writes in live.items():
            for w in writes:
                of_write.setdefault(w, []).append(part)
        placed = f"{columns or self.schema}, w string, {self._names()}"
        if not of_write:
            return spark.createDataFrame([], f"{placed}, file string, mtime timestamp")
        rows = spark.read.format(self.form).schema(placed).option("basePath", f"{self.root}/data").load([f"{self.root}/data/w={w}" for w in sorted(of_write)])
        rows = rows.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("mtime"))
        whole = {e["w"]: len(e["parts"]) for e in log}
        if any(len(parts) < whole[w] for w, parts in of_write.items()):
            rows = rows.where(_any([(F.col("w") == w) & self._among(parts) if len(parts) < whole[w] else F.col("w") == w for w, parts in of_write.items()]))
        replaced = [f"{self.root}/gone/w={e['w']}" for e in log if e["gone"]]
        if not replaced:
            return rows
        gone = spark.read.schema(f"of string, {self._names()}, {self._key_schema()}").parquet(*replaced).withColumnRenamed("of", "w")
        return rows.join(gone, ["w", *self.by, *self.key], "left_anti")

    def _names(self) -> str:
        return ", ".join(f"{c} string" for c in self.by)

    def _key_schema(self) -> str:
        fields = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(self.schema)}
        return ", ".join(f"{c} {fields[c]}" for c in self.key)

    def _among(self, parts: list[tuple]) -> Column:
        """Partitions are named column by column, so that Spark prunes by them."""
        if len(self.by) == 1:
            return F.col(self.by[0]).isin([p[0] for p in parts])
        return _any([_all([F.col(c) == v for c, v in zip(self.by, p, strict=True)]) for p in parts])

    # --- writing

    def merge(self, rows: DataFrame) -> str:
        """Add rows, one a key; they take the place of earlier rows of their keys. Returns the write's name."""
        spark = rows.sparkSession
        w = self._put(rows)
        # the columns of partitions come from the folders' names
        mine = spark.read.format(self.form).schema(f"{self._key_schema()}, {self._names()}").load(f"{self.root}/data/w={w}").select(*self.by, *self.key)
        parts = sorted(tuple(r) for r in mine.select(*self.by).distinct().collect())
        touched = {c: sorted({p[i] for p in parts}) for i, c in enumerate(self.by)}

        def take_place(log: list) -> bool:
            old = self._read(spark, log, touched, self._key_schema()).join(mine, [*self.by, *self.key], "left_semi")
            if old.isEmpty():
                return False
            old.select(F.col("w").alias("of"), *self.by, *self.key).write.mode("overwrite").parquet(f"{self.root}/gone/w={w}")
            return True

        if parts:
            self._commit(spark, w, "merge", parts, self._log(spark), take_place)
        return w

    def rebuild(self, spark: SparkSession, parts: list[tuple], build: Callable[[DataFrame], DataFrame]) -> str:
        """Write partitions anew: build gets their rows as they are, and gives those that they are to hold.

        Where another write touched them meanwhile, build is asked again.
        """
        named = sorted(set(map(tuple, parts)))
        log, done = self._log(spark), False
        while not done:
            held = self._read(spark, log, {c: sorted({p[i] for p in named}) for i, c in enumerate(self.by)})
            w = self._put(build(held.where(self._among(named)) if named else held))
            log, done = self._commit(spark, w, "rebuild", named, log)
        return w

    def compact(self, spark: SparkSession, **where: str | list[str]) -> str | None:
        """Rebuild the partitions that several writes hold, or whose rows were replaced."""
        writes: dict[tuple, int] = {}
        for e in self._log(spark):
            for p in map(tuple, e["parts"]):
                writes[p] = writes.get(p, 0) + 1 if e["mode"] == "merge" else 1
        wanted = [p for p, n in writes.items() if n > 1 and all(p[self.by.index(c)] in ({v} if isinstance(v, str) else v) for c, v in where.items())]
        return self.rebuild(spark, wanted, lambda held: held) if wanted else None

    def _put(self, rows: DataFrame) -> str:
        """Lay rows down under a name of their own; nobody reads them yet."""
        w = uuid.uuid4().hex
        path = f"{self.root}/data/w={w}"
        names = [f.name for f in StructType.fromDDL(self.schema)]
        rows.select(*names, *[F.col(c).cast("string").alias(c) for c in self.by]).write.partitionBy(*self.by).format(self.form).save(path)
        return w

    def _commit(self, spark: SparkSession, w: str, mode: str, parts: list[tuple], log: list, prepare: Callable[[list], bool] = lambda log: False) -> tuple[list, bool]:
        """Name a write in the log: (the log before it, True).

        Whatever others named meanwhile is prepared for anew; where they touched
        partitions of a rebuild, the write stays unnamed: (the longer log, False).
        """
        least = 0
        while True:
            gone = prepare(log)
            n = max([least, *(e["n"] for e in log)]) + 1
            if _create(spark, f"{self.root}/log/{n:08d}.json", json.dumps({"n": n, "w": w, "mode": mode, "gone": gone, "parts": parts})):
                return log, True
            seen, log = len(log), self._log(spark)
            least = n  # a write that broke off may hold this number without a row
            if mode == "rebuild" and set(parts) & {tuple(p) for e in log[seen:] for p in e["parts"]}:
                return log, False


def _any(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out | c
    return out


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _create(spark: SparkSession, path: str, text: str) -> bool:
    """A small file that must not be there yet; False where it is."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    try:
        out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, False)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True

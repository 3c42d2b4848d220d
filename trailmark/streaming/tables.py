"""Tables written once per micro-batch.

Every batch replaces its own partition `batch_id=N`, so a batch that is run again leaves one copy. What a table says is
worked out on reading, by adding the batches' rows; so it does not matter how late a row arrives. Folding keeps reading
cheap: the state as of one batch is stored, and batches up to it are not read any more. They are removed with the next
fold, so that a reader of the state before a fold finds its files.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from trailmark.operators.metrics import observed
from trailmark.sinks import overwrite_partitions
from trailmark.streaming import files

BATCH = "batch_id"
BUCKET = "bucket"
LISTED = 366  # more values than that are not named one by one in a path, but filtered

#: values of a table's partition columns without the batch
Part = tuple[str, ...]


def read_or_empty(spark: SparkSession, path: str, schema: StructType, *folders: str) -> DataFrame:
    """A table's rows with their batch, or none if nothing was written yet. Only the given folders (patterns
    below the path) are listed, as the number of batches grows all the time."""
    schema = schema if BATCH in schema.names else StructType(list(schema)).add(BATCH, LongType())
    try:
        return spark.read.schema(schema).option("basePath", path).parquet("/".join([path, *folders]))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def folder_pattern(column: str, values: Iterable[str] | None) -> str:
    values = None if values is None else sorted(set(values))
    return f"{column}=*" if values is None or len(values) > LISTED else f"{column}={{{','.join(values)}}}"


@dataclass(frozen=True)
class BatchTable:
    """Rows per batch, without meaning across batches: filtered clicks, rejected lines."""

    spark: SparkSession
    path: str
    schema: StructType

    def write(self, df: DataFrame, batch_id: int) -> None:
        # as few files as the batch's size needs, whatever the number of tasks
        rows = df.select(*self.schema.names).hint("rebalance").withColumn(BATCH, F.lit(batch_id).cast("long"))
        overwrite_partitions(rows, self.path, [BATCH])

    def read(self) -> DataFrame:
        return read_or_empty(self.spark, self.path, self.schema)

    def batch(self, batch_id: int) -> DataFrame:
        return read_or_empty(self.spark, self.path, self.schema, f"{BATCH}={batch_id}").drop(BATCH)

    def create(self) -> None:
        """Makes the folder of a table that has no rows yet; leaves an existing one as it is."""
        self.read().limit(0).write.mode("append").partitionBy(BATCH).parquet(self.path)

    def has(self, batch_id: int) -> bool:
        return not self.batch(batch_id).isEmpty()


@dataclass(frozen=True)
class GrowingSet:
    """Rows that are added and never taken away, each with the batch that added it: blacklisted users.

    The table is a pair: a snapshot of everything up to one batch, and the folders of the batches after it. The file
    CURRENT names the snapshot, and is replaced at once. After `fold_every` batches the next snapshot is written; what
    the snapshot before the last one consisted of is removed then. So a batch lists and reads a snapshot and a bounded
    number of small folders, however long the stream has run.
    """

    spark: SparkSession
    path: str
    schema: StructType
    fold_every: int = 100

    def version(self) -> int:
        """The last batch in the snapshot, -1 without one."""
        text = files.read_text(self.spark, f"{self.path}/CURRENT")
        return -1 if text is None else int(text)

    def write(self, df: DataFrame, batch_id: int) -> None:
        BatchTable(self.spark, f"{self.path}/tail", self.schema).write(df, batch_id)
        if batch_id > self.version() + self.fold_every:
            self.fold(batch_id - 1)

    def _snapshot(self, version: int) -> DataFrame:
        stored = StructType(list(self.schema)).add(BATCH, LongType())
        rows = read_or_empty(self.spark, f"{self.path}/snapshots", stored, f"upto={version}")
        return rows.select(*stored.names)

    def read(self) -> DataFrame:
        """All rows with their batch."""
        version = self.version()
        tail = read_or_empty(self.spark, f"{self.path}/tail", self.schema, f"{BATCH}=*")
        tail = tail.where(F.col(BATCH) > version)
        return tail if version < 0 else self._snapshot(version).unionByName(tail)

    def before(self, batch_id: int) -> DataFrame:
        """What batches before this one have added, also if later ones have run already."""
        return self.read().where(F.col(BATCH) < batch_id).drop(BATCH)

    def fold(self, upto: int) -> None:
        """Stores a snapshot as of batch `upto`, which the stream must have finished."""
        last = self.version()
        if upto <= last:
            return
        rows = self.read().where(F.col(BATCH) <= upto).hint("rebalance")
        rows.write.mode("overwrite").parquet(f"{self.path}/snapshots/upto={upto}")
        files.replace_text(self.spark, f"{self.path}/CURRENT", str(upto))
        tail = files.listed(self.spark, f"{self.path}/tail/{BATCH}=*")
        old = [int(n) for n in re.findall(rf"/{BATCH}=(\d+)(?=, |\])", tail)]
        files.remove(self.spark, [f"{self.path}/tail/{BATCH}={n}" for n in old if n <= last])
        shots = files.listed(self.spark, f"{self.path}/snapshots/upto=*")
        old = [int(n) for n in re.findall(r"/upto=(\d+)(?=, |\])", shots)]
        files.remove(self.spark, [f"{self.path}/snapshots/upto={n}" for n in old if n < last])


@dataclass(frozen=True)
class CountTable:
    """`click_count` per key, the first key being `date`; batches hold what is added to each.

    A batch is one folder, whatever its number of dates, with its rows in the order of their parts. After `fold_every`
    batches what they hold is added to the folds, which are stored by part: by date and, with `by`, by a second column
    below it, either a key of the table or, with `buckets`, a hash of that key in so many buckets. All parts touched since
    the last fold are folded, so none waits longer, however rarely it is touched.

    The file FOLDED names the last two folds, and NOTES the parts each batch since then has touched. Both are replaced at
    once. Whoever names the parts wanted lists and reads the folds of these, and of the batches those that touched them.
    """

    spark: SparkSession
    path: str
    schema: StructType
    fold_every: int = 100
    by: str | None = None
    buckets: int | None = None

    @property
    def keys(self) -> list[str]:
        return [name for name in self.schema.names if name != "click_count"]

    @property
    def parts(self) -> list[str]:
        return ["date"] if self.by is None else ["date", BUCKET if self.buckets else self.by]

    @property
    def _stored(self) -> StructType:
        stored = StructType(list(self.schema))
        return stored.add(BUCKET, "string") if self.buckets else stored

    def _part_key(self) -> Column:
        return F.concat_ws("/", *self.parts)

    def _in_parts(self, rows: DataFrame, parts: Sequence[Part] | None) -> DataFrame:
        if parts is None:
            return rows
        for column, values in zip(self.parts, zip(*parts)):
            rows = rows.where(F.col(column).isin(sorted(set(values))))
        if len(self.parts) > 1 and len(parts) <= LISTED:
            rows = rows.where(self._part_key().isin(sorted(map("/".join, parts))))
        return rows

    def _nothing(self) -> DataFrame:
        return read_or_empty(self.spark, f"{self.path}/none", self._stored)

    # batches

    def write(self, df: DataFrame, batch_id: int) -> list[Part]:
        """Stores a batch. Returns the parts it touched, which are noticed while its rows are written."""
        rows = df.select(*self.schema.names)
        if self.buckets:
            rows = rows.withColumn(BUCKET, F.pmod(F.xxhash64(self.by), F.lit(self.buckets)).cast("string"))
        seen = Observation()
        rows = rows.observe(seen, F.collect_set(self._part_key()).alias("parts")).hint("rebalance", *self.parts)
        rows = rows.sortWithinPartitions(*self.parts)
        rows.write.mode("overwrite").parquet(f"{self.path}/batches/{BATCH}={batch_id}")
        found = observed(seen)
        touched = [tuple(key.split("/")) for key in sorted(found["parts"] if found else ())]
        self._note({**self._notes(), batch_id: touched})
        if batch_id > self.folded() + self.fold_every:
            self.fold(batch_id - 1)
        return touched

    def batch(self, batch_id: int, parts: Sequence[Part] | None = None) -> DataFrame:
        return self._in_parts(self._batches([batch_id]), parts).select(*self.schema.names)

    def _batches(self, numbers: Iterable[int]) -> DataFrame:
        numbers = sorted(numbers)
        if not numbers:
            return self._nothing()
        named = f"{BATCH}={{{','.join(map(str, numbers))}}}"
        return read_or_empty(self.spark, f"{self.path}/batches", self._stored, named)

    def _notes(self) -> dict[int, list[Part]]:
        """The parts each batch has touched, of the batches since the fold before the last one."""
        text = files.read_text(self.spark, f"{self.path}/NOTES") or ""
        out = {}
        for line in filter(None, text.split("\n")):
            number, *keys = line.split("\t")
            out[int(number)] = [tuple(key.split("/")) for key in keys]
        return out

    def _note(self, notes: dict[int, list[Part]]) -> None:
        lines = ["\t".join([str(n), *map("/".join, parts)]) for n, parts in sorted(notes.items())]
        files.replace_text(self.spark, f"{self.path}/NOTES", "\n".join(lines))

    # folds

    def _folds(self) -> list[int]:
        return list(map(int, (files.read_text(self.spark, f"{self.path}/FOLDED") or "").split()))

    def folded(self) -> int:
        """The batch up to which the last fold went, -1 before the first."""
        return max(self._folds(), default=-1)

    def _folders(self, parts: Sequence[Part] | None) -> list[str]:
        if parts is not None and len(parts) <= LISTED:
            places = ["/".join(f"{c}={v}" for c, v in zip(self.parts, part)) for part in sorted(parts)]
            return [f"{{{','.join(places)}}}", f"{BATCH}=*"]
        values = [None] * len(self.parts) if parts is None else zip(*parts)
        return [*map(folder_pattern, self.parts, values), f"{BATCH}=*"]

    def _numbers(self, parts: Sequence[Part] | None) -> dict[Part, list[int]]:
        """The folds stored of each part, from the names of the folders."""
        text = files.listed(self.spark, "/".join([self.path, "folds", *self._folders(parts)]))
        columns = "".join(rf"/{c}=([^/]*?)" for c in self.parts)
        out: dict[Part, list[int]] = {}
        for *part, number in re.findall(rf"{columns}/{BATCH}=(\d+)(?=, |\])", text):
            out.setdefault(tuple(part), []).append(int(number))
        return out

    def _folded_rows(self, base: int, parts: Sequence[Part] | None) -> DataFrame:
        """The newest fold up to `base` of each part. Which folder counts is a condition on partition columns, so that
        the others are not opened."""
        newest = {part: max((n for n in ns if n <= base), default=-1) for part, ns in self._numbers(parts).items()}
        known = ",".join(f"{'/'.join(part)}={n}" for part, n in newest.items() if n >= 0)
        if not known:
            return self._nothing()
        rows = read_or_empty(self.spark, f"{self.path}/folds", self._stored, *self._folders(parts))
        names = F.str_to_map(F.lit(known), F.lit(","), F.lit("="))
        fold = F.coalesce(F.try_element_at(names, self._part_key()).cast("long"), F.lit(-1))
        return self._in_parts(rows, parts).where(F.col(BATCH) == fold)

    def rows(self, upto: int | None = None, parts: Sequence[Part] | None = None) -> DataFrame:
        """Folded rows and later batches, up to batch `upto`, with the batch; of the given parts only."""
        names = [*self.schema.names, BATCH]
        if parts is not None and not parts:
            return self._nothing().select(*names)
        base = max((n for n in self._folds() if upto is None or n <= upto), default=-1)
        wanted = None if parts is None else set(parts)
        later = [
            n
            for n, touched in self._notes().items()
            if n > base and (upto is None or n <= upto) and (wanted is None or wanted.intersection(touched))
        ]
        tail = self._in_parts(self._batches(later), parts)
        return self._folded_rows(base, parts).select(*names).unionByName(tail.select(*names))

    def combine(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(F.sum("click_count").alias("click_count"))

    def current(self, upto: int | None = None, parts: Sequence[Part] | None = None) -> DataFrame:
        return self.combine(self.rows(upto, parts))

    def fold(self, upto: int) -> None:
        """Stores the state as of batch `upto`, which the stream must have finished, of all parts touched since the last
        fold. What that fold had replaced is removed."""
        last = self.folded()
        if upto <= last:
            return
        notes = self._notes()
        parts = sorted(set().union(*(touched for n, touched in notes.items() if last < n <= upto)))
        if parts:
            state = self.current(upto, parts)
            if self.buckets:
                state = state.withColumn(BUCKET, F.pmod(F.xxhash64(self.by), F.lit(self.buckets)).cast("string"))
            # adaptive execution cuts a large part into several tasks
            state = state.hint("rebalance", *self.parts).withColumn(BATCH, F.lit(upto).cast("long"))
            overwrite_partitions(state, f"{self.path}/folds", [*self.parts, BATCH])
        files.replace_text(self.spark, f"{self.path}/FOLDED", f"{last} {upto}" if last >= 0 else str(upto))
        gone = [f"batches/{BATCH}={n}" for n in notes if n <= last]
        for part, numbers in (self._numbers(parts) if parts else {}).items():
            before = max((n for n in numbers if n <= last), default=-1)
            place = "/".join(f"{c}={v}" for c, v in zip(self.parts, part))
            gone += [f"folds/{place}/{BATCH}={n}" for n in numbers if n < before]
        files.remove(self.spark, [f"{self.path}/{x}" for x in gone])
        self._note({n: touched for n, touched in notes.items() if n > last})

"""A store polled over and over for its newest rows, as a stream.

Every `every_ms` a poll asks for the rows of the last `span_ms`, so neighbouring polls
overlap and a row that is stored late is still met; the first poll goes `first_ms` back.
A poll's offset is its time, so a restarted stream goes on with the poll after the last
one it finished. Rows of an overlap come twice and are removed by their id within the
watermark.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

NAME = "polled_rows"
SPAN_MS, EVERY_MS, FIRST_MS = 30_000, 10_000, 2 * 3_600_000


def _store(path: str) -> ds.Dataset:
    where, base = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return ds.dataset(base, filesystem=where, format="parquet")


class Poll(InputPartition):
    """Rows with a time in (after, until]."""

    def __init__(self, after: int, until: int):
        super().__init__((after, until))
        self.after, self.until = after, until


class PollReader(DataSourceStreamReader):
    """Offsets are {"until": time of the newest poll}; the store's newest row tells how far polls may go."""

    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.ms, self.schema = options["path"], options.get("ms", "ms"), schema
        self.span = int(options.get("span_ms", SPAN_MS))
        self.every = int(options.get("every_ms", EVERY_MS))
        self.first = int(options.get("first_ms", FIRST_MS))
        self.begin = int(options["begin_ms"])

    def initialOffset(self) -> dict:
        return {"until": self.begin - self.every}

    def _newest(self) -> int:
        found = [pc.max(b.column(0)).as_py() for b in _store(self.path).to_batches(columns=[self.ms]) if b.num_rows]
        return max((x for x in found if x is not None), default=self.begin - self.every)

    def latestOffset(self) -> dict:
        """The first poll that reaches the store's newest row."""
        return {"until": self.begin + max(-1, -(-(self._newest() - self.begin) // self.every)) * self.every}

    def partitions(self, start: dict, end: dict) -> list[Poll]:
        """A split for each poll: the span before it, at the first poll the longer one."""
        times = range(start["until"] + self.every, end["until"] + 1, self.every)
        return [Poll(t - (self.first if t == self.begin else self.span), t) for t in times]

    def commit(self, end: dict) -> None:
        pass

    def read(self, partition: Poll | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no poll is due
            return
        ms = ds.field(self.ms)
        wanted = (ms > partition.after) & (ms <= partition.until)
        names = [f.name for f in self.schema]
        for batch in _store(self.path).to_batches(columns=names, filter=wanted, batch_size=10_000):
            if batch.num_rows:
                yield batch


class PolledRows(DataSource):
    """Options: path of the Parquet store, ms (its column of times), begin_ms, span_ms, every_ms, first_ms."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return from_arrow_schema(_store(self.options["path"]).schema)

    def streamReader(self, schema: StructType) -> PollReader:
        return PollReader(self.options, schema)


def polled(spark: SparkSession, path: str, begin_ms: int, keys: list[str], ms: str = "ms", **options) -> DataFrame:
    """The stored rows as a stream, each once: repeats of overlapping polls go by `keys` within the watermark.

    The watermark trails by the span and one poll, so the id of a row is held as long as
    a poll can bring it again and no longer.
    """
    spark.dataSource.register(PolledRows)
    given = {k: str(v) for k, v in options.items()}
    rows = spark.readStream.format(NAME).options(path=path, ms=ms, begin_ms=str(begin_ms), **given).load()
    hold = int(given.get("span_ms", SPAN_MS)) + int(given.get("every_ms", EVERY_MS))
    timed = rows.withColumn("ts", F.timestamp_millis(F.col(ms))).withWatermark("ts", f"{hold} milliseconds")
    return timed.dropDuplicatesWithinWatermark(keys)

"""Range scans of a salted row-key table with one split for each salt.

The table is the one sinks.tables.write_cells lays out: a folder for each salt, files sorted
by key. A split knows its salt and the key range inside it, opens the files of that folder
alone and skips row groups outside the range; filters on the key narrow the range.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan,
    LessThanOrEqual,
)
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType

from clickloom.functions import rowkeys

NAME = "salted_range"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


class Region(InputPartition):
    """The keys of one salt in [low, high); an empty `high` has no end."""

    def __init__(self, salt: str, low: str, high: str):
        super().__init__((salt, low, high))
        self.salt, self.low, self.high = salt, low, high


def table_at(path: str, salt: str | None = None) -> ds.Dataset:
    """The table, or the files of one salt, on whatever file system the path names."""
    where, base = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    layout = ds.partitioning(pa.schema([("salt", pa.string())]), flavor="hive")
    folder = base if salt is None else f"{base}/salt={salt}"
    if salt is not None and where.get_file_info(folder).type == fs.FileType.NotFound:
        return ds.dataset(pa.table({}))
    return ds.dataset(folder, filesystem=where, format="parquet", partitioning=layout, partition_base_dir=base)


class RegionReader(DataSourceReader):
    def __init__(self, options: dict[str, str], schema: StructType):
        self.path, self.schema = options["path"], schema
        self.key, self.sep = options.get("key", "row_key"), options.get("sep", "|")
        self.salts = int(options.get("salts", rowkeys.SALTS))
        self.start, self.stop = options.get("start", ""), options.get("stop", "")
        self.low, self.high = "", ""  # bounds of the salted key from pushed filters

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Comparisons of the key narrow the splits; all are handed back, as their exact sense stays Spark's."""
        for f in filters:
            if getattr(f, "attribute", None) == (self.key,):
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.low = max(self.low, f.value)
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    last = f.value + "\0" if not isinstance(f, LessThan) else f.value  # the next key there is
                    self.high = min(self.high, last) if self.high else last
            yield f

    def partitions(self) -> list[Region]:
        found = []
        for i in range(self.salts):
            salt = chr(65 + i)
            head = salt + self.sep
            low = max(head + self.start, self.low)
            high = head + self.stop if self.stop else salt + chr(ord(self.sep[0]) + 1)
            high = min(high, self.high) if self.high else high
            if low < high:
                found.append(Region(salt, low, high))
        return found

    def read(self, partition: Region | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # no range at all
            return
        table = table_at(self.path, partition.salt)
        names = [f.name for f in self.schema]
        if self.key not in table.schema.names:
            return
        key = ds.field(self.key)
        wanted = (key >= partition.low) & (key < partition.high)
        for batch in table.to_batches(columns=names, filter=wanted, batch_size=10_000):
            if batch.num_rows:
                yield batch


class SaltedRange(DataSource):
    """Options: path, start and stop of the unsalted key, key, sep, salts."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> StructType:
        return from_arrow_schema(table_at(self.options["path"]).schema)

    def reader(self, schema: StructType) -> RegionReader:
        return RegionReader(self.options, schema)


def scan(spark: SparkSession, path: str, start: str = "", stop: str = "", **options: str) -> DataFrame:
    """Rows whose unsalted key is in [start, stop) (empty: no bound), a task for each salt.

    The path is one that the Python workers can open: a shared folder, or a file system
    that pyarrow knows by its URI. Where it isn't, storage.scan_salted_range reads the same
    rows through the engine's own reader.
    """
    spark.conf.set(PUSHDOWN, "true")
    spark.dataSource.register(SaltedRange)
    return spark.read.format(NAME).options(path=path, start=start, stop=stop, **options).load()

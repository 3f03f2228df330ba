"""Text lines of a stream in files that roll by size or by age.

Each task writes its own files into a staging folder; a file is closed and another begun
when it has reached the size or has been open for the time. When all tasks are done the
batch is committed: its files get their names, under its number, and what an earlier run of
the same batch had left goes. A task or a batch that fails takes its staged files away; what
a lost executor had staged stays in the staging folder, which no reader looks into.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

NAME = "rolling_text"
MAX_BYTES, MAX_SECONDS = 2_048, 3_600
STAGED = "_staged"


@dataclass
class Written(WriterCommitMessage):
    """The staging folder of a task, and (folder, staged file) of what it wrote."""

    folder: str = ""
    files: list[tuple[str, str]] = field(default_factory=list)


class RollingWriter(DataSourceStreamWriter):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.max_bytes = int(options.get("maxBytes", MAX_BYTES))
        self.max_seconds = float(options.get("maxSeconds", MAX_SECONDS))

    def _place(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.path or self.path.startswith("file:"):
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path

    def write(self, iterator) -> Written:
        where, base = self._place()
        folder = f"{base}/{STAGED}/{uuid.uuid4().hex}"
        where.create_dir(folder, recursive=True)
        done = Written(folder)
        opened: dict[str, tuple] = {}  # of a folder: stream, bytes so far, time of its opening
        try:
            for row in iterator:
                line, day = (row.value or "").encode("utf-8", "surrogatepass") + b"\n", row.folder or ""
                if day in opened:
                    stream, size, since = opened[day]
                    if size + len(line) > self.max_bytes or time.monotonic() - since >= self.max_seconds:
                        opened.pop(day)[0].close()
                if day not in opened:
                    name = f"{folder}/{len(done.files)}"
                    opened[day] = (where.open_output_stream(name), 0, time.monotonic())
                    done.files.append((day, name))
                stream, size, since = opened[day]
                stream.write(line)
                opened[day] = (stream, size + len(line), since)
        except BaseException:
            for stream, *_ in opened.values():
                stream.close()
            where.delete_dir(folder)
            raise
        for stream, *_ in opened.values():
            stream.close()
        return done

    @staticmethod
    def _clear(where: fs.FileSystem, messages) -> None:
        for message in messages:
            if message is not None:
                where.delete_dir(message.folder)

    def commit(self, messages, batchId: int) -> None:
        where, base = self._place()
        named = []
        for part, message in enumerate(m for m in messages if m is not None):
            for number, (day, staged) in enumerate(message.files):
                folder = f"{base}/{day}" if day else base
                named.append((staged, f"{folder}/batch-{batchId:010d}-{part:05d}-{number:05d}.txt"))
        for old in where.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=True)):
            if old.is_file and old.base_name.startswith(f"batch-{batchId:010d}-"):
                where.delete_file(old.path)
        for folder in {target.rpartition("/")[0] for _, target in named}:
            where.create_dir(folder, recursive=True)
        for staged, target in named:
            where.move(staged, target)
        self._clear(where, messages)

    def abort(self, messages, batchId: int) -> None:
        self._clear(self._place()[0], messages)


class RollingText(DataSource):
    """Options: path, maxBytes, maxSeconds. Rows have a value and a folder."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def streamWriter(self, schema, overwrite: bool) -> RollingWriter:
        return RollingWriter(self.options)


def stream_rolling_text(
    df: DataFrame, path: str, checkpoint: str, columns: list[Column], day: Column, trigger: str | None = None,
    max_bytes: int = MAX_BYTES, max_seconds: float = MAX_SECONDS,
) -> StreamingQuery:
    """Lines joined with "|" in one folder per day, in files of at most `max_bytes` and `max_seconds`.

    A line longer than the size has a file of its own. The path is one that the driver and
    the Python workers can open: a shared folder, or a file system that pyarrow knows by its URI.
    """
    from clickloom.sinks.tables import stream_to

    df.sparkSession.dataSource.register(RollingText)
    rows = df.select(F.concat_ws("|", *columns).alias("value"), day.cast("string").alias("folder"))
    options = {"path": path, "maxBytes": str(max_bytes), "maxSeconds": str(max_seconds)}
    return stream_to(rows, checkpoint, trigger).format(NAME).options(**options).start()

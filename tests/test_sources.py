"""Sources and sinks of the data source API, rejected records, sketches and merged types."""

import random
from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import rows
from pyspark.sql import functions as F
from pyspark.sql.datasource import GreaterThanOrEqual, LessThan
from test_streams import EVENT, drain, read_json, write_files

from clickloom.functions import clock, rowkeys
from clickloom.operators import online, parsing, storage
from clickloom.sinks import rolling, tables
from clickloom.sources import polled, regions, streams

# Salted ranges


@pytest.fixture(scope="module")
def cells(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cells") / "table")
    bare = F.lpad(F.col("id").cast("string"), 6, "0")
    key = F.concat_ws("|", rowkeys.salt_letter(rowkeys.text_salt(bare)), bare)
    tables.write_cells(spark.range(5_000).select(key.alias("row_key"), (F.col("id") * 2).alias("v")), path)
    return path


def test_a_split_for_each_salt_with_its_range(spark, cells):
    found = regions.scan(spark, cells, "001000", "003000")
    assert found.rdd.getNumPartitions() == rowkeys.SALTS
    plain = spark.read.parquet(cells)
    assert rows(found, "row_key", "v") == rows(storage.scan_salted_range(plain, "001000", "003000"), "row_key", "v")
    assert found.count() == 2_000
    reader = regions.RegionReader({"path": cells, "start": "001000", "stop": "003000"}, found.schema)
    splits = reader.partitions()
    assert [(s.salt, s.low, s.high) for s in splits] == [(c, f"{c}|001000", f"{c}|003000") for c in "ABCDEF"]
    assert regions.scan(spark, cells).count() == 5_000


def test_a_split_opens_no_file_of_another_salt(spark, cells, monkeypatch):
    schema = regions.scan(spark, cells).schema
    opened = []
    plain = regions.table_at

    def watched(path, salt=None):
        table = plain(path, salt)
        opened.extend(getattr(table, "files", []))
        return table

    monkeypatch.setattr(regions, "table_at", watched)
    reader = regions.RegionReader({"path": cells, "start": "001000", "stop": "001100"}, schema)
    split = reader.partitions()[2]
    got = [k for b in reader.read(split) for k in b.column("row_key").to_pylist()]
    assert got == sorted(got) and all(k.startswith("C|0010") for k in got) and got
    assert opened and all("/salt=C/" in f for f in opened)


def test_filters_on_the_key_narrow_the_splits(spark, cells):
    schema = regions.scan(spark, cells).schema
    reader = regions.RegionReader({"path": cells}, schema)
    held = [GreaterThanOrEqual(("row_key",), "B|001000"), LessThan(("row_key",), "C|000500")]
    assert list(reader.pushFilters(held)) == held
    assert [(s.salt, s.low, s.high) for s in reader.partitions()] == [("B", "B|001000", "B}"), ("C", "C|", "C|000500")]
    got = regions.scan(spark, cells).where("row_key >= 'B|001000' AND row_key < 'C|000500' AND v % 4 = 0")
    plain = spark.read.parquet(cells).where("row_key >= 'B|001000' AND row_key < 'C|000500' AND v % 4 = 0")
    assert rows(got, "row_key") == rows(plain, "row_key") != []
    assert regions.scan(spark, cells, "5", "4").count() == 0


# Polls


def test_polled_rows_come_once_also_after_a_restart(spark, tmp_path):
    rnd, store = random.Random(2), tmp_path / "store"
    store.mkdir()
    begin = 10_000_000

    def put(name, times, first):
        table = pa.table({"id": list(range(first, first + len(times))), "ms": times})
        pq.write_table(table, store / f"{name}.parquet")

    early = [begin - rnd.randrange(2 * 3_600_000) for _ in range(200)] + [begin - 3 * 3_600_000]
    put("a", early + [begin + rnd.randrange(1, 100_000) for _ in range(300)], 0)

    def go():
        found = polled.polled(spark, str(store), begin, ["id"])
        drain(found.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
              .foreachBatch(lambda b, i: tables.overwrite_partition(b.withColumn("batch", F.lit(i)), str(tmp_path / "out"), "batch"))
              .start())
        return sorted(r.id for r in spark.read.parquet(str(tmp_path / "out")).collect())

    got = go()
    # All but the row of three hours ago, each once.
    assert got == [i for i in range(501) if i != 200]
    put("b", [begin + 100_000 + rnd.randrange(1, 60_000) for _ in range(100)], 1_000)
    assert go() == got + list(range(1_000, 1_100))


def test_polls_overlap_and_the_first_goes_further_back(tmp_path):
    pq.write_table(pa.table({"id": [1], "ms": [100_000]}), tmp_path / "x.parquet")
    reader = polled.PollReader({"path": str(tmp_path), "begin_ms": "60000"}, None)
    start = reader.initialOffset()
    end = reader.latestOffset()
    assert (start, end) == ({"until": 50_000}, {"until": 100_000})
    got = [(p.after, p.until) for p in reader.partitions(start, end)]
    assert got[0] == (60_000 - polled.FIRST_MS, 60_000) and got[1:] == [(t - 30_000, t) for t in range(70_000, 100_001, 10_000)]


# Rolling text files


def lines_of(folder):
    files = sorted(p for p in Path(folder).rglob("*.txt"))
    return {str(p.relative_to(folder)): p.read_text().splitlines() for p in files}


def test_files_roll_by_size_and_land_in_their_days(spark, tmp_path):
    day = 86_400_000
    data = [{"event_type": f"event{i:04d}", "user_id": i, "ms": 1_704_067_200_000 + (i % 2) * day} for i in range(60)]
    folder = write_files(tmp_path / "in", [data[:40], data[40:]])
    query = rolling.stream_rolling_text(
        read_json(spark, folder, EVENT), str(tmp_path / "out"), str(tmp_path / "cp"),
        [F.col("event_type"), F.col("user_id")], clock.format_millis(F.col("ms"), clock.DAY), max_bytes=100)
    drain(query)
    found = lines_of(tmp_path / "out")
    assert sorted(x for v in found.values() for x in v) == sorted(f"event{i:04d}|{i}" for i in range(60))
    assert all(sum(len(x) + 1 for x in v) <= 100 for v in found.values()) and len(found) >= 8
    assert {k.split("/")[0] for k in found} == {"2024-01-01", "2024-01-02"}
    assert not list((tmp_path / "out" / rolling.STAGED).iterdir())


def writer(path, **options):
    return rolling.RollingWriter({"path": str(path), **options})


class Line:
    def __init__(self, value, folder="d"):
        self.value, self.folder = value, folder


def test_files_roll_by_age_and_replays_replace(tmp_path, monkeypatch):
    now = iter(range(0, 1_000, 10))
    monkeypatch.setattr(rolling.time, "monotonic", lambda: next(now))
    w = writer(tmp_path, maxBytes="100000", maxSeconds="25")
    w.commit([w.write(iter([Line(str(i)) for i in range(9)])), None], 3)
    found = lines_of(tmp_path)
    assert len(found) >= 3 and [x for v in found.values() for x in v] == [str(i) for i in range(9)]
    monkeypatch.undo()
    again = writer(tmp_path)  # the batch runs anew, with other rows of other size
    again.commit([again.write(iter([Line("x"), Line(None, "e")]))], 3)
    assert lines_of(tmp_path) == {"d/batch-0000000003-00000-00000.txt": ["x"], "e/batch-0000000003-00000-00001.txt": [""]}


def test_an_aborted_batch_leaves_nothing(tmp_path):
    w = writer(tmp_path)
    good = w.write(iter([Line("a"), Line("b")]))

    def broken():
        yield Line("c")
        raise ValueError("gone")

    with pytest.raises(ValueError):
        w.write(broken())
    w.abort([good, None], 0)
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


# Rejected records


RECORDS = [
    '{"time": 1, "event": "a"}', '{"time": "x", "event": "b"}', "no json", '{"time": 2}', None, '{"time": 3, "event": "c"}', "[]", "",
]


def test_every_record_is_accepted_or_rejected(spark):
    frame = spark.createDataFrame([(r,) for r in RECORDS], "value string")
    seen = streams.declared(frame, "time bigint, event string", ["event"], mode="reject")
    got = {r.value: r.reject for r in seen.collect()}
    assert len(got) == len(RECORDS)
    assert got[None] == "no text" and got['{"time": 2}'] == "no event" and got['{"time": "x", "event": "b"}'] == "not as declared"
    assert sorted(k for k, v in got.items() if v is None) == [RECORDS[0], RECORDS[5]]
    kept = streams.declared(frame, "time bigint, event string", ["event"])
    assert rows(kept) == [(1, "a"), (3, "c")]
    with pytest.raises(Exception, match="record rejected"):
        streams.declared(frame, "time bigint, event string", ["event"], mode="fail").collect()
    with pytest.raises(ValueError):
        streams.declared(frame, "time bigint", mode="other")


def test_rejects_have_an_output_and_the_progress_counts_them(spark, tmp_path):
    (tmp_path / "in").mkdir()
    texts = [r for r in RECORDS if r]
    (tmp_path / "in" / "0.txt").write_text("\n".join(texts))
    seen = streams.declared(streams.read_folder(spark, str(tmp_path / "in")), "time bigint, event string", ["event"], mode="reject")

    def into(name):
        return lambda batch, batch_id: tables.overwrite_partition(
            batch.withColumn("batch", F.lit(batch_id)), str(tmp_path / name), "batch")

    query = (seen.writeStream.option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True)
             .foreachBatch(streams.with_rejects(into("good"), into("bad"))).start())
    drain(query)
    good, bad = spark.read.parquet(str(tmp_path / "good")), spark.read.parquet(str(tmp_path / "bad"))
    assert rows(good, "time", "event") == [(1, "a"), (3, "c")]
    assert sorted(r.value for r in bad.collect()) == sorted(set(texts) - {RECORDS[0], RECORDS[5]})
    told = [p.observedMetrics["declared"] for p in query.recentProgress if "declared" in (p.observedMetrics or {})]
    assert sum(t.accepted for t in told) == 2 and sum(t.rejected for t in told) == len(texts) - 2


# Sketches and merged types


def test_panes_are_rows_of_fixed_size_and_unite(spark, tmp_path):
    data = [("r", i % 3_000, i % 60) for i in range(30_000)]
    df = spark.createDataFrame(data, "room string, device int, s int").withColumn("ts", F.timestamp_seconds(F.col("s") + 600))
    panes = online.device_panes(df, "ts", ["room"], "device")
    sizes = {r.n for r in panes.select(F.length("devices").alias("n")).collect()}
    assert panes.count() == 12 and max(sizes) < 8_192
    panes.write.parquet(str(tmp_path / "panes"))
    found = online.viewers_of_panes(spark.read.parquet(str(tmp_path / "panes")), ["room"])
    exact = {r.window_start: r.online_counts for r in online.window_viewers(df, "ts", ["room"], "device").collect()}
    got = {r.window_start: r.estimate for r in found.collect()}
    assert set(got) == set(exact) and all(abs(got[w] - n) <= 0.1 * n + 0.5 for w, n in exact.items())


def test_merged_types_of_nested_and_odd_lines(spark):
    lines = ['{"a": 1, "o": {"x": 1}}', '{"a": 2.5, "o": {"y": "t"}}', '{"a": null, "b": []}', "broken", None, "[1]", "{}"]
    found = {r.key: (r.type, r.n_rows) for r in parsing.merged_types(spark.createDataFrame([(x,) for x in lines], "line string")).collect()}
    assert found["a"][1] == 3 and found["a"][0].startswith("DECIMAL")
    assert found["o"] == ("OBJECT<x: BIGINT, y: STRING>", 2) and found["b"][1] == 1
    assert set(found) == {"a", "b", "o"}

"""Exact duplicates by a stateful stream over digests.

Each text's digest goes through a streaming aggregation whose disk-backed keyed
state never expires. For each digest it retains the largest identifier, the
locator of that row's content (file and row in it) and the number of rows. Where a
digest was hit again, the full bytes of the rows are compared with the bytes at
the retained locator; rows whose bytes differ are grouped by their text instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from clickloom.session import cut_lineage, shared_folder

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The state is on disk; a store is closed once its batch is committed, and reserves no space ahead.
STATE = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
HASH, SIZE, KEEP, LOCATOR = "__digest", "__rows", "__keep", "__locator"
SHA, VARIANT = "__sha", "__variant"


def normalised(text: Column) -> Column:
    """Null as empty, A-Z as a-z, all else as it is."""
    return F.translate(F.coalesce(text, F.lit("")), CAPITALS, CAPITALS.lower())


def sha256_of(text: Column) -> Column:
    return F.sha2(normalised(text).cast("binary"), 256)


def _located(docs: DataFrame) -> DataFrame:
    """Add the locator of each row: the file and the row in it that hold its content.

    A frame that isn't read straight from files is written to the shared folder first.
    """
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    try:
        return docs.select("*", place.alias(LOCATOR))
    except Exception as error:  # an analysis error: the frame has no files of its own
        if "_metadata" not in str(error):
            raise
        return cut_lineage(docs).select("*", place.alias(LOCATOR))


def _groups(staged: DataFrame, folder: str) -> DataFrame:
    """Run the stream over the staged digests and return the state it ends with.

    A batch writes the digests it changed under its own number, so a batch that
    is run again replaces itself; a digest's last batch is what holds.
    """
    spark = staged.sparkSession
    kept = F.max(F.struct(KEEP, LOCATOR))
    state = (
        spark.readStream.schema(staged.schema)  # the columns it names, of those stored
        .parquet(f"{folder}/digests")
        .groupBy(HASH)
        .agg(F.count(F.lit(1)).alias(SIZE), kept.alias("__top"))
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/groups/batch={number}")

    before = {key: spark.conf.get(key, None) for key in STATE}
    for key, value in STATE.items():
        spark.conf.set(key, value)
    try:
        query = (
            state.writeStream.outputMode("update")
            .foreachBatch(write)
            .option("checkpointLocation", f"{folder}/state")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    query.awaitTermination()
    schema = StructType([*state.schema.fields, StructField("batch", LongType())])
    changes = spark.read.schema(schema).parquet(f"{folder}/groups")
    last = F.max_by(F.struct(SIZE, "__top"), "batch").alias("__last")
    return (
        changes.groupBy(HASH).agg(last).select(
            HASH, f"__last.{SIZE}", F.col(f"__last.__top.{KEEP}").alias(KEEP),
            F.col(f"__last.__top.{LOCATOR}").alias(LOCATOR),
        )
    )


def deduplicate(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    digest: Callable[[Column], Column] = sha256_of,
) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256, locator): a row for each row of `docs`.

    Texts are equal when they are after lower-casing A-Z only; null counts as
    empty. Of equal texts the row with the largest id is kept; a null id is below
    all others. Rows alike in id and text are told apart by where they are
    stored, and one of them is kept. Other columns are left out; an empty table
    gives an empty result.
    """
    return _deduplicated(_located(docs), docs.sparkSession, doc_id, text, digest)


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, one of each text."""
    located = _located(docs)
    found = _deduplicated(located, docs.sparkSession, doc_id, text, sha256_of)
    stays = found.where("kept").select(F.col("locator").alias(LOCATOR))
    return located.join(stays, LOCATOR, "left_semi").select(docs.columns)


def _deduplicated(located: DataFrame, spark, doc_id: str, text: str, digest) -> DataFrame:
    folder = f"{shared_folder(spark)}/clickloom-dedup-{uuid.uuid4().hex}"
    rows = located.withColumns({HASH: digest(F.col(text)), KEEP: F.col(doc_id)})
    rows = rows.withColumn(SHA, F.col(HASH) if digest is sha256_of else sha256_of(F.col(text)))
    rows.select(HASH, KEEP, LOCATOR, SHA).write.parquet(f"{folder}/digests")
    staged = spark.read.parquet(f"{folder}/digests")
    groups = cut_lineage(_groups(staged.select(HASH, KEEP, LOCATOR), folder))
    differing = _differing(rows, groups, text)
    staged = staged.withColumn(VARIANT, F.lit(""))
    groups = groups.withColumn(VARIANT, F.lit(""))
    if not differing.isEmpty():
        # The rows of such digests are grouped by their text; the others stay as they are.
        odd = rows.join(differing, HASH, "left_semi").withColumn(VARIANT, normalised(F.col(text)))
        top = F.max(F.struct(KEEP, LOCATOR)).alias("__top")
        own = odd.groupBy(HASH, VARIANT).agg(F.count(F.lit(1)).alias(SIZE), top)
        own = own.select(HASH, SIZE, f"__top.{KEEP}", f"__top.{LOCATOR}", VARIANT)
        groups = groups.join(differing, HASH, "left_anti").unionByName(own)
        staged = staged.join(differing, HASH, "left_anti").unionByName(
            odd.select(HASH, KEEP, LOCATOR, SHA, VARIANT)
        )
    found = groups.withColumnsRenamed({KEEP: "keep_id", SIZE: "group_size", LOCATOR: "__kept_at"})
    return staged.join(found, [HASH, VARIANT]).select(
        F.col(KEEP).alias("doc_id"), "keep_id", "group_size",
        (F.col(LOCATOR) == F.col("__kept_at")).alias("kept"),
        F.col(SHA).alias("text_sha256"), F.col(LOCATOR).alias("locator"),
    )


def _differing(rows: DataFrame, groups: DataFrame, text: str) -> DataFrame:
    """Digests that stand for more than one text: full bytes against those at the locator."""
    hit = groups.where(F.col(SIZE) > 1).select(HASH, F.col(LOCATOR).alias("__kept_at"))
    # The texts are thinned out by a short key first; written, its size is known to the planner.
    keys = cut_lineage(hit.select(F.xxhash64(HASH).alias("__key")).distinct())
    thin = rows.withColumn("__key", F.xxhash64(HASH)).join(keys, "__key", "left_semi")
    held = cut_lineage(thin.select(HASH, LOCATOR, normalised(F.col(text)).alias("__own")).join(hit, HASH))
    first = held.where(F.col(LOCATOR) == F.col("__kept_at")).select(HASH, F.col("__own").alias("__first"))
    others = held.where(F.col(LOCATOR) != F.col("__kept_at")).select(HASH, "__own")
    return cut_lineage(others.join(first, HASH).where(F.col("__own") != F.col("__first")).select(HASH).distinct())

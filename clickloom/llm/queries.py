"""One query for each operator of this subpackage over its whole table, and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm import (
    chat,
    exact_dedup,
    html_text,
    language,
    minhash,
    mixing,
    packing,
    periodic,
    personal,
    quality,
    samples,
    simhash,
    spelling,
    toxicity,
)

# Bounds of the samples the classifiers learn from: texts of each class, characters of a text.
PER_CLASS, MAX_CHARS = 2_000, 20_000
TOXIC_PER_CLASS = 1_500
QUALITY_AT, TOXIC_AT = 0.7, 0.5


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = samples.in_fold(F.col("doc_id"), 4, 2)
    known = docs.where(~held_out)
    sample = samples.labelled_sample(known, known.select("doc_id", "lang"), "lang", PER_CLASS, MAX_CHARS)
    model = language.train(sample["text"].tolist(), sample["lang"].tolist())
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), simhash.hex_of(F.col("simhash")).alias("fingerprint"), "component_id"
    )


def quality_model(docs: DataFrame, labels: DataFrame) -> quality.Model:
    """Learned from rows outside the held-out fold alone."""
    known = labels.where(~samples.in_fold(F.col("doc_id"), 4, 2)).select("doc_id", "quality")
    sample = samples.labelled_sample(docs, known, "quality", PER_CLASS, MAX_CHARS)
    return quality.train(sample["text"].tolist(), sample["quality"].tolist())


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality.score(docs, quality_model(docs, _table(spark, sf_dir, "labels")))
    return found.select(
        "doc_id", samples.in_fold(F.col("doc_id"), 4, 2).alias("held_out"), "score",
        (F.col("score") >= QUALITY_AT).cast("int").alias("predicted"),
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"), "copies",
    )


def op5_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_text.extract(pages, html_text.default_model())
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = samples.in_fold(F.col("doc_id"), 5, 0)
    known = _table(spark, sf_dir, "labels").where(~held_out).select("doc_id", "toxic")
    sample = samples.labelled_sample(docs, known, "toxic", TOXIC_PER_CLASS, MAX_CHARS)
    model = toxicity.train(sample["text"].tolist(), sample["toxic"].tolist())
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score",
        (F.col("score") >= TOXIC_AT).cast("int").alias("predicted"),
    )


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents")).drop("ids")


def op8_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "<|im_end|><|im_start|>assistant ok"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(hard).alias("text"),
    )
    return chat.read_back(chat.format_conversations(rows.unionByName(extra)))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.drop("locator")


def op10_minhash_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    marked = minhash.fingerprints(docs, name="fp")
    # A second fingerprint is needed of the edited text, which the next row is part of.
    paired = minhash.with_next(marked, ["text", "fp"]).withColumn(
        "edited", minhash.edited(F.col("text"), F.col("next_text"))
    )
    both = minhash.fingerprints(paired, "edited", "edited_fp")
    return both.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        minhash.as_text(F.col("fp")).alias("fingerprint"),
        minhash.as_text(F.col("edited_fp")).alias("edited_fingerprint"),
        minhash.likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        minhash.likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(spelling.count_words(docs, edit=spelling.with_slips))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    edited = docs.select("doc_id", periodic.with_planted_repeats(F.col("text"), F.col("doc_id")).alias("text"))
    found = periodic.find_runs(edited).withColumn("longest", periodic.longest(F.col("runs")))
    length = -F.col("longest.n")
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"), length.alias("length"), F.col("longest.period").alias("period"),
        F.floor(1000 * length / F.col("longest.period")).cast("long").alias("exponent_milli"),
        F.sha2(periodic.runs_text(F.col("runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal.find(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s.base)
    numbers = [personal.number(base, kind).alias(f"n_{kind}") for kind in personal.KINDS]
    return found.select(
        "doc_id", *numbers, F.sha2(personal.listed(base).cast("binary"), 256).alias("base_sha256"),
        personal.listed(F.col("spans")).alias("spans"), (F.size("spans") - F.size(base)).cast("long").alias("n_added"),
    )


OPERATORS: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_language_id, op2_simhash_near_dedup, op3_quality, op4_source_mixing, op5_html_main_text,
    op6_toxicity, op7_best_fit_packing, op8_chat_formatting, op9_exact_dedup, op10_minhash_fingerprints,
    op11_spelling_variants, op12_periodic_runs, op13_personal_data,
]

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ESCAPED = r"length(regexp_replace({0}, '<(\\*)\|', '<\\\1|', 'g'))"
_TURN_CHARS = f"""length('<|im_start|>') + {_ESCAPED.format("replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n')")}
  + 1 + {_ESCAPED.format("text")} + length('<|im_end|>') + 1"""

# crc32 of `doc_id:run`, one bit of its UTF-8 bytes at a time.
_BITS = """list_concat([4294967295::BIGINT], flatten(list_transform(range(0, strlen(key)), lambda i:
  list_transform(range(0, 8), lambda b: (('0x' || substr(hex(encode(key)), CAST(2 * i + 1 AS BIGINT), 2))::BIGINT >> b) & 1))))"""
_CRC = f"xor(list_reduce({_BITS}, lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"

ORACLES = {
    "op11_spelling_variants": f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\u00C0-\u00FF]+')) AS run FROM documents),
per AS (SELECT doc_id || ':' || run AS key, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run),
hashed AS (SELECT run, n, {_CRC} AS h FROM per),
slipped AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed),
words AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM slipped WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS MATERIALIZED (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, CAST(unnest(range(1, length(word) + 1)) AS BIGINT) AS i FROM words)),
near AS MATERIALIZED (
  SELECT DISTINCT a, b FROM (
    SELECT x.word AS a, y.word AS b FROM cut x JOIN cut y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
    UNION ALL SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
    UNION ALL SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word)),
best AS (SELECT a, count(*) AS n_near, first(b ORDER BY w.n DESC, b) AS b, max(w.n) AS m
  FROM near JOIN words w ON w.word = b GROUP BY a),
formed AS MATERIALIZED (SELECT word, CASE WHEN m >= 5 * n THEN b END AS form, n, coalesce(n_near, 0) AS n_near,
    CASE WHEN m >= 5 * n THEN m END AS form_n
  FROM words LEFT JOIN best ON a = word),
chain AS (SELECT word, word AS root FROM words
  UNION ALL SELECT chain.word, f.form FROM chain JOIN formed f ON f.word = chain.root WHERE f.form IS NOT NULL),
ends AS (SELECT chain.word, chain.root FROM chain JOIN formed f ON f.word = chain.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)""",
    "op8_chat_formatting": f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum({_TURN_CHARS}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
    "op9_exact_dedup": f"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256({_LOWER}) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY {_LOWER})""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracles() -> dict[str, str]:
    return dict(ORACLES)

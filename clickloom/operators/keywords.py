"""Words, term weights and keyword rankings, as relational operators keyed by term.

Term weight = term count * ln((docs + 1) / (doc frequency + 1)).
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions import words as W
from clickloom.operators.skew import salted_join
from clickloom.session import cut_lineage

TOP_TERMS = 20
# Documents counted at once in a task; share of all postings above which a
# term is joined by broadcast (so fewer terms than this, whatever the data).
COUNTED_AT_ONCE = 256
BROADCAST_WAYS = 1 << 19


def tokens(
    docs: DataFrame,
    text: Column,
    keys: list[str],
    patterns=(),
    stop_words: DataFrame | None = None,
    segmenter=None,
) -> DataFrame:
    """One row per token (keys + term) of the whole text.

    segmenter   optional function Column -> Column of token arrays (a pandas UDF
                around a language-specific library); default: letters and digits
    patterns    tokens matching one are dropped
    stop_words  frame with one column `term`; spread-salted, so a very common
                stop word does not load one task
    """
    split = segmenter(text) if segmenter else W.split_words(text)
    out = docs.select(
        *keys,
        F.posexplode(W.drop_patterns(split, patterns)).alias("pos", "term"),
    )
    if stop_words is not None:
        listed = stop_words.select(F.lower("term").alias("term")).distinct()
        out = salted_join(out, listed, ["term"], [*keys, "pos"], "left_anti")
    return out


def stop_word_table(spark, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Stop words, one per line."""
    return (
        spark.read.option("encoding", encoding).option("sep", "\x01").csv(path, schema="term string")
        .where(F.col("term") != "")
    )


def token_arrays(rows: DataFrame, keys: list[str], alias: str = "words") -> DataFrame:
    """Tokens of each document back as one array (bounded by the document)."""
    ordered = F.array_sort(F.collect_list(F.struct("pos", "term")))
    return rows.groupBy(*keys).agg(F.transform(ordered, lambda x: x["term"]).alias(alias))


def _by_identity(docs: DataFrame, keys: list[str]) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose keys come once, rows whose keys come again or None); nulls are one key."""
    named = [F.col(k).alias(f"__{k}") for k in keys]
    again = cut_lineage(
        docs.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(*named)
    )
    if again.isEmpty():
        return docs, None
    same = reduce(lambda a, b: a & b, [docs[k].eqNullSafe(again[f"__{k}"]) for k in keys])
    return docs.join(again, same, "left_anti"), docs.join(again, same, "left_semi")


def document_words(
    docs: DataFrame, text: Column, keys: list[str], patterns=(), alias: str = "words"
) -> DataFrame:
    """token_arrays of whole texts; a row whose keys come once keeps its words and is not shuffled."""
    once, again = _by_identity(docs, keys)
    words = W.drop_patterns(W.split_words(text), patterns)
    # An array of none or one array, so that the words are made once and empty ones have no row.
    held = F.filter(F.array(words), lambda w: F.size(w) > 0)
    out = once.select(*keys, F.explode(held).alias(alias))
    if again is None:
        return out
    return out.unionByName(token_arrays(tokens(again, text, keys, patterns), keys, alias))


def _counted_words(keys: list[str]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, COUNTED_AT_ONCE):
                part = batch.slice(at, COUNTED_AT_ONCE)
                lists = part.column("words")
                coded = lists.flatten().dictionary_encode(null_encoding="encode")
                if not len(coded):
                    continue
                sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
                place = np.repeat(np.arange(part.num_rows, dtype=np.int64), sizes)
                pairs, counts = np.unique(
                    place * len(coded.dictionary) + coded.indices.to_numpy(), return_counts=True
                )
                row, term = np.divmod(pairs, len(coded.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [part.column(k).take(pa.array(row)) for k in keys]
                    + [coded.dictionary.take(pa.array(term)), pa.array(counts, pa.int64())],
                    [*keys, "term", "tf"],
                )

    return count


def document_terms(
    docs: DataFrame,
    text: Column,
    keys: list[str],
    patterns=(),
    stop_words: DataFrame | None = None,
    segmenter=None,
) -> DataFrame:
    """term_counts of the tokens of whole texts: (keys, term, tf).

    A document whose keys come once is counted where it is read, so no token is
    shuffled; rows that share their keys are counted together by term_counts.
    """
    once, again = _by_identity(docs, keys)
    split = segmenter(text) if segmenter else W.split_words(text)
    kept = [docs.schema[k] for k in keys]
    schema = T.StructType(
        [*kept, T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]
    )
    out = once.select(*keys, split.alias("words")).mapInArrow(_counted_words(keys), schema)
    if patterns:
        # Terms are fewer than tokens.
        out = out.where(~F.col("term").rlike("|".join(f"(?:{p})" for p in patterns)))
    if stop_words is not None:
        listed = stop_words.select(F.lower("term").alias("term")).distinct()
        out = salted_join(out, listed, ["term"], keys, "left_anti")
    if again is None:
        return out
    rows = tokens(again, text, keys, patterns, stop_words, segmenter)
    return out.unionByName(term_counts(rows, keys))


def word_count(docs: DataFrame, text: Column, separator: str = " ") -> DataFrame:
    return (
        docs.select(F.explode(F.split(text, separator)).alias("word"))
        .groupBy("word")
        .agg(F.count("*").alias("num"))
    )


def term_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys, "term").agg(F.count("*").alias("tf"))


def doc_frequency(tf: DataFrame) -> DataFrame:
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def idf_table(tf: DataFrame, n_docs: Column, min_df: int = 0) -> DataFrame:
    """(term, df, idf); terms in fewer than min_df documents get weight 0."""
    weight = F.log((n_docs + 1) / (F.col("df") + 1))
    idf = F.when(F.col("df") >= min_df, weight).otherwise(F.lit(0.0)) if min_df else weight
    return doc_frequency(tf).select("term", "df", idf.alias("idf"))


def count_docs(docs: DataFrame) -> Column:
    """Number of documents as a scalar sub-query (evaluated once, by the plan itself)."""
    return docs.agg(F.count("*")).scalar()


def hot_terms(idf: DataFrame, ways: int = 64) -> DataFrame:
    """Terms with more than 1/ways of all postings: fewer than `ways` rows by construction."""
    total = idf.agg(F.sum("df")).scalar()
    return idf.where(F.col("df") * ways > total).select("term")


def frequent_terms(idf: DataFrame, most: int = BROADCAST_WAYS) -> DataFrame:
    """The most frequent terms, all of a document frequency or none: at most `most` of them."""
    counted = idf.groupBy("df").agg(F.count("*").alias("n"))
    # One row for each frequency, which are few.
    ahead = counted.withColumn("ahead", F.sum("n").over(Window.orderBy(F.desc("df"))))
    least = ahead.where(F.col("ahead") <= most).agg(F.min("df")).scalar()
    return idf.where(F.col("df") >= least).select("term")


def term_join(
    rows: DataFrame, table: DataFrame, frequent: DataFrame, how: str = "inner"
) -> DataFrame:
    """Rows with a table keyed by term, without a shuffle for the terms listed in `frequent`.

    Most postings belong to few terms: those meet their part of the table by
    broadcast where they are; only the postings of other terms, none of them
    hot, are shuffled. `rows` is read twice, `table` too: both should be written.
    """
    listed = cut_lineage(frequent.select("term"))
    near = rows.join(F.broadcast(listed.join(table, "term", how)), "term")
    rest = [x.join(F.broadcast(listed), "term", "left_anti") for x in (rows, table)]
    far = rest[0].join(rest[1], "term", how)
    return near.unionByName(far)


def tf_idf(tf: DataFrame, idf: DataFrame, keys: list[str]) -> DataFrame:
    """Weight of each (document, term), in no order of `keys`; `tf` should be written."""
    idf = cut_lineage(idf)  # read by the list and both parts of the join
    joined = term_join(tf, idf, frequent_terms(idf))
    return joined.withColumn("weight", F.col("tf") * F.col("idf"))


def _best_of_runs(keys: list[str], n: int, slack: float):
    """Drops rows that n rows of the same keys beside them in the batch outweigh by more than `slack`."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            begins = np.zeros(batch.num_rows, dtype=bool)
            for k in keys:
                codes = batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy()
                begins[1:] |= codes[1:] != codes[:-1]
            begins[0] = True
            run = np.cumsum(begins) - 1
            weight = pc.fill_null(batch.column("weight"), -np.inf).to_numpy().astype("float64")
            weight = np.where(np.isnan(weight), np.inf, weight)
            order = np.lexsort((-weight, run))
            starts = np.flatnonzero(begins)
            last = np.minimum(starts + n, np.append(starts[1:], len(run))) - 1
            # Equal weights stay, so the smaller term can win.
            keep = weight >= weight[order][last][run] - slack
            yield batch.filter(pa.array(keep))

    return best


def top_terms(
    weights: DataFrame, keys: list[str], n: int = TOP_TERMS, digits: int | None = None
) -> DataFrame:
    """The n heaviest terms of each document; ties go to the smaller term.

    With `digits`, weights equal when rounded to them tie. The terms of a document
    mostly lie together: what n neighbours outweigh is dropped there, the rest is
    ranked by a window.
    """
    slack = 0.0 if digits is None else 2 * 10.0**-digits
    held = weights.mapInArrow(_best_of_runs(keys, n, slack), weights.schema)
    shown = F.col("weight") if digits is None else F.round("weight", digits)
    order = Window.partitionBy(*keys).orderBy(F.desc("__shown"), "term")
    ranked = held.withColumn("__shown", shown).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= n).drop("__shown")


def keyword_ranking(top: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """How many documents have each keyword among their top terms, most frequent first."""
    counted = top.groupBy(*(keys or []), F.col("term").alias("keyword")).agg(
        F.count("*").alias("num")
    )
    return counted.orderBy(*(keys or []), F.desc("num"), "keyword")


def daily_keywords(
    docs: DataFrame,
    text: Column,
    doc: str,
    day: str,
    patterns=(),
    stop_words: DataFrame | None = None,
    n: int = TOP_TERMS,
    segmenter=None,
) -> DataFrame:
    """Keyword ranking per day, all days in one pass.

    Weights come from one document-frequency table over the whole input, so the
    days share one vocabulary.
    """
    tf = cut_lineage(document_terms(docs, text, [day, doc], patterns, stop_words, segmenter))
    weights = tf_idf(tf, idf_table(tf, count_docs(docs)), [day, doc])
    shown = weights.select(day, doc, "term", "weight")
    return keyword_ranking(top_terms(shown, [day, doc], n), [day])

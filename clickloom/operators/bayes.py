"""Multinomial naive Bayes over term weights, trained and applied as joins.

score(label) = prior + sum over terms of weight * ln((W[label, term] + s) / (W[label] + s * V))

Split into a part every label has (the total weight times the denominator) and
a part only for terms seen with the label, so unseen pairs need no row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.operators.keywords import BROADCAST_WAYS, term_join
from clickloom.operators.skew import heavy_keys, in_blocks
from clickloom.session import cut_lineage

LABELS = "__labels"


def with_labels(
    docs: DataFrame, labels: DataFrame, doc: str, label: str = "label", how: str = "left"
) -> DataFrame:
    """Documents with all their labels in one column, for train to read beside the terms.

    The texts are joined, which are far smaller than their weights.
    """
    listed = F.array_sort(F.collect_list(F.struct(F.col(label).alias("label"))))
    return docs.join(labels.groupBy(doc).agg(listed.alias(LABELS)), doc, how)


def train(
    weights: DataFrame, labels: DataFrame, doc: str, label: str = "label", smoothing: float = 1.0
) -> tuple[DataFrame, DataFrame]:
    """(terms, priors).

    terms   term -> map label -> ln((W[label, term] + s) / s)
    priors  label -> ln prior, ln(W[label] + s * V) and ln s

    Weights of documents that went through with_labels are not joined again.
    """
    known = labels.select(doc, F.col(label).cast("string").alias("label"))
    if LABELS in weights.columns:
        own = weights.select("term", "weight", F.explode(LABELS).alias("x"))
        rows = own.select("term", "weight", F.col("x.label").cast("string").alias("label"))
    else:
        rows = weights.join(known, doc)
    seen = rows.groupBy("label", "term").agg(F.sum("weight").alias("w"))
    gain = F.log((F.col("w") + smoothing) / smoothing)
    terms = seen.groupBy("term").agg(
        F.map_from_entries(F.collect_list(F.struct("label", gain))).alias("gains")
    )
    vocabulary = weights.agg(F.count_distinct("term")).scalar()
    # Weight of a label; a label whose documents have no weight still has a prior.
    totals = seen.groupBy("label").agg(F.sum("w").alias("w"))
    docs = known.groupBy("label").agg(F.count("*").alias("n"))
    all_docs = known.agg(F.count("*")).scalar()
    labels_n = known.agg(F.count_distinct("label")).scalar()
    priors = docs.join(totals, "label", "left").select(
        "label",
        (F.log(F.col("n") + smoothing) - F.log(all_docs + labels_n * smoothing)).alias("prior"),
        (
            F.log(F.coalesce("w", F.lit(0.0)) + vocabulary * F.lit(smoothing))
            - F.log(F.lit(smoothing))
        ).alias("denominator"),
    )
    return terms, priors


def scores(weights: DataFrame, terms: DataFrame, priors: DataFrame, doc: str) -> DataFrame:
    """(doc, label, score) for every label.

    Documents meet the labels a block at a time; the terms of the model that have
    most postings go to the weights, which are shuffled for the others only.
    """
    frequent = heavy_keys(weights, ["term"], BROADCAST_WAYS)
    shown = weights.select(doc, "term", "weight")
    gained = term_join(shown, cut_lineage(terms), frequent, "left").select(
        doc, "weight", F.explode_outer("gains").alias("label", "gain")
    )
    per_label = gained.where(F.col("label").isNotNull()).groupBy(doc, "label").agg(
        F.sum(F.col("weight") * F.col("gain")).alias("gain")
    )
    totals = weights.groupBy(doc).agg(F.sum("weight").alias("total"))
    base = (
        in_blocks(totals, priors, "label", [doc])
        .select(doc, "total", F.explode("entries").alias("p"))
        .select(doc, "total", "p.label", "p.prior", "p.denominator")
    )
    score = (
        F.col("prior")
        - F.col("total") * F.col("denominator")
        + F.coalesce("gain", F.lit(0.0))
    )
    return base.join(per_label, [doc, "label"], "left").select(doc, "label", score.alias("score"))


def predict(scored: DataFrame, doc: str) -> DataFrame:
    """Label with the best score; ties go to the smaller label."""
    best = F.min_by("label", F.struct(-F.col("score"), F.col("label")))
    return scored.groupBy(doc).agg(best.alias("prediction"))


def accuracy(predictions: DataFrame, labels: DataFrame, doc: str, label: str = "label") -> DataFrame:
    known = labels.select(doc, F.col(label).cast("string").alias("label"))
    hit = (F.col("prediction") == F.col("label")).cast("double")
    return predictions.join(known, doc).agg(
        F.avg(hit).alias("accuracy"), F.count("*").alias("n_rows")
    )

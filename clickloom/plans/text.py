"""Text jobs: keyword rankings, similarity, classification, recommendations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.operators import bayes, keywords, learning, similarity
from clickloom.session import cut_lineage


def daily_keywords(docs: DataFrame, text: Column, doc: str, day: str, **options) -> DataFrame:
    return keywords.daily_keywords(docs, text, doc, day, **options)


def term_weights(docs: DataFrame, text: Column, doc: str, patterns=(), min_df: int = 0,
                 stop_words: DataFrame | None = None, carried: tuple[str, ...] = ()) -> DataFrame:
    """(doc, term, tf, df, idf, weight) of whole texts, with the columns `carried` of a document."""
    keys = [doc, *carried]
    # Read by the document frequencies and both parts of the join: counted once.
    tf = cut_lineage(keywords.document_terms(docs, text, keys, patterns, stop_words))
    idf = keywords.idf_table(tf, keywords.count_docs(docs), min_df)
    return keywords.tf_idf(tf, idf, keys)


def document_similarity(docs: DataFrame, text: Column, doc: str, threshold: float) -> DataFrame:
    return similarity.similar_documents(term_weights(docs, text, doc), doc, threshold)


def text_classifier(docs: DataFrame, text: Column, doc: str, labels: DataFrame,
                    label: str = "label", min_df: int = 3) -> DataFrame:
    """Naive Bayes over tf-idf: trained on the labelled documents, applied to all of them."""
    return bayes.predict(classifier_scores(docs, text, doc, labels, label, min_df), doc)


def classifier_scores(docs: DataFrame, text: Column, doc: str, labels: DataFrame,
                      label: str = "label", min_df: int = 3) -> DataFrame:
    """(doc, label, score) behind text_classifier."""
    known = bayes.with_labels(docs, labels, doc, label)
    weights = term_weights(known, text, doc, min_df=min_df, carried=(bayes.LABELS,))
    # Read by training, scoring and the list of frequent terms: computed once.
    weights = cut_lineage(weights.select(doc, bayes.LABELS, "term", "weight"))
    terms, priors = bayes.train(weights, labels, doc, label)
    return bayes.scores(weights, terms, priors, doc)


def held_out_predictions(docs: DataFrame, text: Column, doc: str, labels: DataFrame, train: Column,
                         label: str = "label", min_df: int = 3) -> DataFrame:
    """(doc, prediction) of labelled documents outside `train`, a condition on the id.

    Vocabulary, document frequencies and counts come from the training documents
    alone; other terms do not count. A document may have several labels, each a
    row of `labels`; the prediction is the best one.
    """
    known = labels.where(F.col(label).isNotNull())
    used = bayes.with_labels(docs, known, doc, label, "inner")
    keys = [doc, bayes.LABELS]
    tf = cut_lineage(keywords.document_terms(used, text, keys))
    idf = keywords.idf_table(tf.where(train), keywords.count_docs(used.where(train)), min_df)
    weights = cut_lineage(keywords.tf_idf(tf, idf, keys).select(*keys, "term", "weight"))
    terms, priors = bayes.train(weights.where(train), known.where(train), doc, label)
    return bayes.predict(bayes.scores(weights.where(~train), terms, priors, doc), doc)


def classifier_accuracy(docs: DataFrame, text: Column, doc: str, labels: DataFrame, train: Column,
                        label: str = "label") -> DataFrame:
    """Accuracy on the documents held out."""
    predicted = held_out_predictions(docs, text, doc, labels, train, label)
    return bayes.accuracy(predicted, labels.where(~train), doc, label)


def recommendations(ratings: DataFrame, side: str = "users", percent: int = 80, seed: int = 7):
    """(top-n rows, held-out error) of a factor model."""
    train, test = learning.split_by_hash(ratings, F.struct("user", "item"), percent)
    model = learning.recommender(seed).fit(train)
    return learning.recommendations(model, side), learning.rmse_table(model.transform(test))

"""Words, keyword rankings, similarity, classification, recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from clickloom.functions import words as W
from clickloom.operators import bayes, keywords, learning, similarity
from clickloom.plans import text as jobs
from clickloom.registry.base import EVENT_CTE, WORDS_CTE, Tables, query
from clickloom.session import cut_lineage

THRESHOLD = 0.8


@query(
    "word_count",
    """SELECT word, count(*) AS num FROM (
         SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""",
)
def word_count(spark, sf):
    return keywords.word_count(Tables(spark, sf).documents, F.col("text"))


@query(
    "document_tokens",
    """SELECT doc_id, count(*) AS n_tokens, count(DISTINCT w) AS n_terms,
              min(w) AS first_term, max(w) AS last_term
       FROM (SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS w
             FROM documents)
       WHERE length(w) > 1 AND NOT regexp_matches(w, '^[0-9]+$')
         AND w NOT IN (SELECT DISTINCT unnest(regexp_split_to_array(lower(r_name), ' ')) FROM region)
       GROUP BY doc_id""",
)
def document_tokens(spark, sf):
    t = Tables(spark, sf)
    stop = t.table("region").select(F.explode(F.split(F.lower("r_name"), " ")).alias("term"))
    rows = keywords.tokens(
        t.documents, F.col("text"), ["doc_id"], W.LATIN_STOP_PATTERNS, stop
    )
    return rows.groupBy("doc_id").agg(
        F.count("*").alias("n_tokens"), F.count_distinct("term").alias("n_terms"),
        F.min("term").alias("first_term"), F.max("term").alias("last_term"),
    )


@query(
    "symbols_stripped",
    """SELECT page_id, length(regexp_replace(regexp_replace(
                regexp_replace(html, '<[^>]*>', ' ', 'g'),
                '[\\r\\n 　\\t]', '', 'g'),
                '[\\p{P}\\p{S}\\p{C}\\p{N}\\p{Z}]', '', 'g')) AS n_letters
       FROM pages""",
)
def symbols_stripped(spark, sf):
    text = W.strip_symbols(W.strip_tags(F.col("html")))
    return Tables(spark, sf).table("pages").select(
        "page_id", F.length(text).cast("bigint").alias("n_letters")
    )


@query(
    "term_counts",
    f"WITH {WORDS_CTE} SELECT tf.doc_id, tf.term, tf.tf, df.df FROM tf JOIN df ON tf.term = df.term",
)
def term_counts(spark, sf):
    docs = Tables(spark, sf).documents
    tf = cut_lineage(keywords.document_terms(docs, F.col("text"), ["doc_id"]))
    idf = keywords.idf_table(tf, F.lit(1))
    return keywords.tf_idf(tf, idf, ["doc_id"]).select("doc_id", "term", "tf", "df")


@query(
    "inverse_document_frequency",
    f"""WITH {WORDS_CTE}
        SELECT term, df, round(CASE WHEN df >= 3 THEN ln((nd.n + 1.0) / (df + 1.0)) ELSE 0 END, 6)
               AS idf FROM df, nd""",
)
def inverse_document_frequency(spark, sf):
    docs = Tables(spark, sf).documents
    tf = keywords.document_terms(docs, F.col("text"), ["doc_id"])
    idf = keywords.idf_table(tf, keywords.count_docs(docs), min_df=3)
    return idf.select("term", "df", F.round("idf", 6).alias("idf"))


@query(
    "term_weights",
    f"WITH {WORDS_CTE} SELECT doc_id, term, round(weight, 6) AS weight FROM wt",
)
def term_weights(spark, sf):
    rows = jobs.term_weights(Tables(spark, sf).documents, F.col("text"), "doc_id")
    return rows.select("doc_id", "term", F.round("weight", 6).alias("weight"))


@query(
    "top_terms",
    f"""WITH {WORDS_CTE}
        SELECT doc_id, term, CAST(rn AS INTEGER) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY doc_id
                    ORDER BY round(weight, 9) DESC, term) AS rn FROM wt) WHERE rn <= 20""",
)
def top_terms(spark, sf):
    weights = jobs.term_weights(Tables(spark, sf).documents, F.col("text"), "doc_id")
    shown = weights.select("doc_id", "term", "weight")
    return keywords.top_terms(shown, ["doc_id"], digits=9).select("doc_id", "term", "rank")


@query(
    "daily_keywords",
    """WITH tok AS (
         SELECT doc_id, source, term FROM (
           SELECT doc_id, source,
                  unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term
           FROM documents) WHERE length(term) > 1 AND NOT regexp_matches(term, '^[0-9]+$')),
       tf AS (SELECT source, doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
       df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
       wt AS (SELECT source, doc_id, tf.term,
                     tf.tf * ln(((SELECT count(*) FROM documents) + 1.0) / (df.df + 1.0)) AS weight
              FROM tf JOIN df ON tf.term = df.term),
       top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source, doc_id
                 ORDER BY round(weight, 9) DESC, term) AS rn FROM wt) WHERE rn <= 20)
       SELECT source, term AS keyword, count(*) AS num FROM top GROUP BY ALL""",
)
def daily_keywords(spark, sf):
    """Documents have no date; their source takes the place of the day."""
    return jobs.daily_keywords(
        Tables(spark, sf).documents, F.col("text"), "doc_id", "source",
        patterns=W.LATIN_STOP_PATTERNS,
    )


@query(
    "document_similarity",
    f"""WITH {WORDS_CTE},
        nm AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM wt GROUP BY doc_id),
        u AS (SELECT wt.doc_id, term, weight / norm AS w FROM wt JOIN nm ON wt.doc_id = nm.doc_id
              WHERE norm > 0 AND weight <> 0),
        sig AS (SELECT doc_id, list(term || ':' || CAST(round(w, 12) AS VARCHAR) ORDER BY term)
                  AS s FROM u GROUP BY doc_id),
        rep AS (SELECT min(doc_id) AS doc_id, count(*) AS copies FROM sig GROUP BY s),
        k AS (SELECT u.*, rep.copies FROM u JOIN rep ON u.doc_id = rep.doc_id)
        SELECT x.doc_id AS doc_1, y.doc_id AS doc_2, round(sum(x.w * y.w), 6) AS similarity,
               x.copies AS copies_1, y.copies AS copies_2
        FROM k x JOIN k y ON x.term = y.term AND x.doc_id < y.doc_id
        GROUP BY ALL HAVING sum(x.w * y.w) >= {THRESHOLD}""",
)
def document_similarity(spark, sf):
    rows = jobs.document_similarity(Tables(spark, sf).documents, F.col("text"), "doc_id", THRESHOLD)
    return rows.withColumn("similarity", F.round("similarity", 6))


@query(
    "document_copies",
    f"""WITH {WORDS_CTE},
        nm AS (SELECT doc_id, sqrt(sum(weight * weight)) AS norm FROM wt GROUP BY doc_id),
        sig AS (SELECT wt.doc_id, list(term || ':' || CAST(round(weight / norm, 12) AS VARCHAR)
                  ORDER BY term) AS s FROM wt JOIN nm ON wt.doc_id = nm.doc_id
                WHERE norm > 0 AND weight <> 0 GROUP BY wt.doc_id)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS representative FROM sig""",
)
def document_copies(spark, sf):
    weights = jobs.term_weights(Tables(spark, sf).documents, F.col("text"), "doc_id")
    return similarity.copy_groups(weights, "doc_id")


@query(
    "keyword_listing",
    f"""WITH {WORDS_CTE}
        SELECT doc_id, term, tf, round(weight, 6) AS weight FROM wt WHERE df >= 3""",
)
def keyword_listing(spark, sf):
    weights = jobs.term_weights(Tables(spark, sf).documents, F.col("text"), "doc_id", min_df=3)
    return weights.where("df >= 3").select(
        "doc_id", "term", "tf", F.round("weight", 6).alias("weight")
    )


_BAYES = """lab AS (SELECT doc_id, CAST(quality AS VARCHAR) AS label FROM labels),
wm AS (SELECT doc_id, term, CASE WHEN df >= 3 THEN weight ELSE 0 END AS weight FROM wt),
s AS (SELECT label, term, sum(weight) AS w FROM wm JOIN lab ON wm.doc_id = lab.doc_id GROUP BY ALL),
tot AS (SELECT label, sum(w) AS w FROM s GROUP BY label),
pri AS (SELECT lab.label, ln((count(*) + 1.0) / ((SELECT count(*) FROM lab)
          + (SELECT count(DISTINCT label) FROM lab))) AS prior, any_value(tot.w) AS w
        FROM lab LEFT JOIN tot ON lab.label = tot.label GROUP BY lab.label),
voc AS (SELECT count(DISTINCT term) AS v FROM wm),
sc AS (SELECT wm.doc_id, pri.label,
              any_value(pri.prior) + sum(wm.weight * ln((COALESCE(s.w, 0) + 1.0)
                / (pri.w + voc.v))) AS score
       FROM wm CROSS JOIN pri CROSS JOIN voc
       LEFT JOIN s ON s.label = pri.label AND s.term = wm.term
       GROUP BY wm.doc_id, pri.label)"""


@query(
    "text_classifier",
    f"""WITH {WORDS_CTE}, {_BAYES}
        SELECT doc_id, arg_max(label, score) AS prediction FROM sc GROUP BY doc_id""",
)
def text_classifier(spark, sf):
    t = Tables(spark, sf)
    labels = t.table("labels").select("doc_id", F.col("quality").alias("label"))
    return jobs.text_classifier(t.documents, F.col("text"), "doc_id", labels)


@query(
    "classifier_scores",
    f"""WITH {WORDS_CTE}, {_BAYES} SELECT doc_id, label, round(score, 4) AS score FROM sc""",
)
def classifier_scores(spark, sf):
    t = Tables(spark, sf)
    labels = t.table("labels").select("doc_id", F.col("quality").alias("label"))
    rows = jobs.classifier_scores(t.documents, F.col("text"), "doc_id", labels)
    return rows.select("doc_id", "label", F.round("score", 4).alias("score"))


def _held_out(lab: str) -> str:
    """SQL twin of held_out_predictions over lab (doc_id, label); ids ending in 8 and 9 are held out."""
    return f"""lab AS ({lab}),
tr AS (SELECT * FROM lab WHERE doc_id % 10 < 8),
tok AS (
  SELECT doc_id, term FROM (
    SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS term
    FROM documents WHERE doc_id IN (SELECT doc_id FROM lab)) WHERE term <> ''),
tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf WHERE doc_id IN (SELECT doc_id FROM tr) GROUP BY term),
nd AS (SELECT count(DISTINCT doc_id) AS n FROM tr),
wm AS (SELECT tf.doc_id, tf.term, CASE WHEN df >= 3 THEN tf * ln((n + 1.0) / (df + 1.0)) ELSE 0 END
         AS weight FROM tf JOIN df ON tf.term = df.term, nd),
s AS (SELECT label, term, sum(weight) AS w FROM wm JOIN tr ON wm.doc_id = tr.doc_id GROUP BY ALL),
tot AS (SELECT label, sum(w) AS w FROM s GROUP BY label),
pri AS (SELECT tr.label, ln((count(*) + 1.0) / ((SELECT count(*) FROM tr)
          + (SELECT count(DISTINCT label) FROM tr))) AS prior, any_value(coalesce(tot.w, 0)) AS w
        FROM tr LEFT JOIN tot ON tr.label = tot.label GROUP BY tr.label),
voc AS (SELECT count(*) AS v FROM df),
sc AS (SELECT wm.doc_id, pri.label,
              any_value(pri.prior) + sum(wm.weight * ln((COALESCE(s.w, 0) + 1.0)
                / (pri.w + voc.v))) AS score
       FROM wm CROSS JOIN pri CROSS JOIN voc
       LEFT JOIN s ON s.label = pri.label AND s.term = wm.term
       WHERE wm.doc_id % 10 >= 8 GROUP BY wm.doc_id, pri.label),
p AS (SELECT doc_id, arg_max(label, score) AS prediction FROM sc GROUP BY doc_id)"""


def _in_train():
    return F.col("doc_id") % 10 < 8


@query(
    "classifier_accuracy",
    f"""WITH {_held_out("SELECT doc_id, CAST(quality AS VARCHAR) AS label FROM labels WHERE quality IS NOT NULL")}
        SELECT round(avg(CASE WHEN p.prediction = lab.label THEN 1.0 ELSE 0.0 END), 6)
                 AS accuracy, count(*) AS n_rows
        FROM p JOIN lab ON p.doc_id = lab.doc_id""",
)
def classifier_accuracy(spark, sf):
    """Learned from ids ending in 0 to 7, measured on the others."""
    t = Tables(spark, sf)
    labels = t.table("labels").select("doc_id", F.col("quality").alias("label"))
    rows = jobs.classifier_accuracy(t.documents, F.col("text"), "doc_id", labels, _in_train())
    return rows.select(F.round("accuracy", 6).alias("accuracy"), "n_rows")


@query(
    "probe_similarity",
    """SELECT v.vec_id, p.vec_id AS probe,
              round(list_cosine_similarity(CAST(v.embedding AS DOUBLE[]),
                                           CAST(p.embedding AS DOUBLE[])), 5) AS cosine
       FROM embeddings v
       JOIN (SELECT * FROM embeddings WHERE vec_id IN
              (SELECT min(vec_id) FROM embeddings GROUP BY label)) p ON v.vec_id <> p.vec_id""",
)
def probe_similarity(spark, sf):
    """Every vector against one probe per label (the first vector of the label)."""
    vectors = Tables(spark, sf).table("embeddings")
    probes = vectors.groupBy("label").agg(
        F.min_by(F.struct("vec_id", "embedding"), "vec_id").alias("p")
    ).select("p.*")
    rows = similarity.nearest_to(vectors, probes, "vec_id", "embedding")
    return rows.select("vec_id", "probe", F.round("cosine", 5).alias("cosine"))


@query(
    "count_vector_keywords",
    """WITH tok AS (
         SELECT doc_id, term FROM (
           SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term
           FROM documents) WHERE length(term) > 1 AND NOT regexp_matches(term, '^[0-9]+$')),
       tf AS (SELECT doc_id, term, count(*) AS tf FROM tok GROUP BY ALL),
       df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
       wt AS (SELECT doc_id, tf.term, tf.tf * ln(((SELECT count(*) FROM documents) + 1.0) / (df.df + 1.0))
                AS weight FROM tf JOIN df ON tf.term = df.term)
       SELECT doc_id, term, round(weight, 6) AS weight, CAST(rn AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(weight, 9) DESC, term) AS rn
         FROM wt) WHERE rn <= 20""",
)
def count_vector_keywords(spark, sf):
    """Top terms by counts and idf over the whole vocabulary, which stays a table keyed by term."""
    weights = jobs.term_weights(
        Tables(spark, sf).documents, F.col("text"), "doc_id", W.LATIN_STOP_PATTERNS
    )
    # Ranked by rounded weights, so equal ones tie on both engines; shown from the unrounded ones.
    top = keywords.top_terms(weights.select("doc_id", "term", "weight"), ["doc_id"], digits=9)
    return top.select("doc_id", "term", F.round("weight", 6).alias("weight"), "rank")


@query(
    "multi_label_model",
    f"""WITH {_held_out('''SELECT doc_id, lang AS label FROM documents WHERE lang IS NOT NULL
          UNION SELECT doc_id, source FROM documents WHERE source IS NOT NULL''')}
        SELECT p.doc_id, lab.label AS label_str, p.prediction FROM p JOIN lab ON p.doc_id = lab.doc_id""",
)
def multi_label_model(spark, sf):
    """Language and source as labels of a document, learned from the text alone."""
    docs = Tables(spark, sf).documents
    labels = docs.select("doc_id", F.explode(F.array("lang", "source")).alias("label"))
    labels = labels.where(F.col("label").isNotNull()).distinct()
    predicted = jobs.held_out_predictions(docs, F.col("text"), "doc_id", labels, _in_train())
    return predicted.join(labels, "doc_id").select(
        "doc_id", F.col("label").alias("label_str"), "prediction"
    )


# ---- pyspark.ml pipelines (rows only but for the totals) ----------------------


def _words(t: Tables):
    return keywords.document_words(t.documents, F.col("text"), ["doc_id"], W.LATIN_STOP_PATTERNS)


@query("hashed_features")
def hashed_features(spark, sf):
    words = _words(Tables(spark, sf))
    out = learning.hashed_features(min_docs=learning.CLASSIFIER_MIN_DOCS).fit(words).transform(words)
    return out.select("doc_id", learning.stored_entries(F.col("features")).alias("entries")).select(
        "doc_id", F.inline("entries")
    )


@query(
    "hashed_feature_totals",
    """SELECT doc_id, CAST(count(*) AS DOUBLE) AS total FROM (
         SELECT doc_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS term
         FROM documents) WHERE length(term) > 1 AND NOT regexp_matches(term, '^[0-9]+$')
       GROUP BY doc_id""",
)
def hashed_feature_totals(spark, sf):
    """Sum of all buckets of a document, which is the same for any hash."""
    words = _words(Tables(spark, sf))
    out = learning.hashed_features().fit(words).transform(words)
    entries = learning.stored_entries(F.col("rawFeatures"))
    total = F.aggregate(entries, F.lit(0.0), lambda acc, x: acc + x["value"])
    return out.select("doc_id", total.alias("total"))


@query("naive_bayes_model")
def naive_bayes_model(spark, sf):
    t = Tables(spark, sf)
    labels = t.table("labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    # The labels go to the texts, which are far smaller than their words.
    docs = bayes.with_labels(t.documents, labels, "doc_id", how="inner")
    words = keywords.document_words(
        docs, F.col("text"), ["doc_id", bayes.LABELS], W.LATIN_STOP_PATTERNS
    )
    rows = words.select("doc_id", "words", F.inline(bayes.LABELS))
    train, test = learning.split_by_hash(rows, F.col("doc_id"), 80)
    model = learning.text_classifier().fit(train)
    return model.transform(test).select("doc_id", "label", "prediction")


def _ratings(t: Tables):
    return t.events.groupBy(
        F.col("user_id").cast("int").alias("user"), F.col("k").alias("item")
    ).agg(F.avg("value").cast("float").alias("rating"))


@query("recommended_items")
def recommended_items(spark, sf):
    return jobs.recommendations(_ratings(Tables(spark, sf)), "users")[0]


@query("recommended_users")
def recommended_users(spark, sf):
    return jobs.recommendations(_ratings(Tables(spark, sf)), "items")[0]


def _ranked(rows, key, other):
    """Of each list: its length, distinct entries, first and last rank, whether scores fall with the rank."""
    entries = F.array_sort(F.collect_list(F.struct("rank", "score")))
    falling = F.zip_with(
        F.slice("x", 1, F.greatest(F.size("x") - 1, F.lit(0))), F.slice("x", 2, F.size("x")),
        lambda a, b: a["score"] >= b["score"],
    )
    held = rows.groupBy(key).agg(
        F.count("*").alias("n"), F.count_distinct(other).alias("n_distinct"),
        F.min("rank").cast("bigint").alias("first_rank"),
        F.max("rank").cast("bigint").alias("last_rank"), entries.alias("x"),
    )
    return held.withColumn("falling", F.forall(falling, lambda ok: ok)).drop("x")


def _ranked_sql(key: str, other: str) -> str:
    return f"""WITH {EVENT_CTE}, n AS (SELECT least({learning.TOP_N}, count(DISTINCT {other})) AS n FROM e)
      SELECT DISTINCT CAST({key} AS INTEGER) AS {{0}}, n.n, n.n AS n_distinct, 1 AS first_rank,
             n.n AS last_rank, true AS falling FROM e, n"""


@query("recommended_items_ranked", _ranked_sql("user_id", "k").format("\"user\""))
def recommended_items_ranked(spark, sf):
    """Every user has the ten best distinct items, in falling order."""
    rows = jobs.recommendations(_ratings(Tables(spark, sf)), "users", percent=100)[0]
    return _ranked(rows, "user", "item")


@query("recommended_users_ranked", _ranked_sql("k", "user_id").format("item"))
def recommended_users_ranked(spark, sf):
    rows = jobs.recommendations(_ratings(Tables(spark, sf)), "items", percent=100)[0]
    return _ranked(rows, "item", "user")

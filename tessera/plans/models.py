"""Classifiers and topic models on the labelled documents and the embeddings."""

from pyspark.sql import functions as F

from tessera.functions import text
from tessera.operators import balance, classify, evaluate, margins, topics
from tessera.operators.describe import class_weights
from tessera.operators.terms import TermClassifier
from tessera.plans.registry import query, rounded
from tessera.plans.texts import MAILS
from tessera.session import SMALL_GROUPS, fresh_path, load, load_spread, written
from tessera.sources.writers import load_model, save_model
from tessera.streaming import runs, scoring

LABELS = ["quality", "toxic"]


def corpus(spark, d, column):
    """Labelled documents with their mail ``tokens`` or comment ``words``; only labelled texts are taken apart."""
    pieces = {"tokens": text.mail_tokens, "words": text.comment_words}[column](F.col("text"))
    documents = load_spread(spark, d, "documents", "doc_id").select("doc_id", "text").join(load(spark, d, "labels"), "doc_id")
    return written(documents.withColumn(column, pieces).drop("text"), "corpus", **SMALL_GROUPS)


@query("mail_classifier_report")
def mail_classifier_report(spark, d):
    train, test = balance.stratified_split(corpus(spark, d, "tokens"), "doc_id", "toxic", 0.2)
    model = TermClassifier.fit(written(train, "train"), "doc_id", "tokens", "toxic")
    scored = model.transform(written(test, "test"), "doc_id", "tokens", ["toxic"])
    return rounded(evaluate.class_report(scored.select(F.col("toxic").alias("y"), "predicted")))


@query("mail_classifier_terms", f"""with {MAILS},
c as (select doc_id, tokens from m join labels using (doc_id)), t as (select doc_id, unnest(tokens) as token from c),
g as (select token, count(distinct doc_id) as documents, (select count(*) from c) as n from t group by 1)
select token, documents, round(ln((1 + n) / (1 + documents)) + 1, 6) as idf, true as at_optimum from g
where documents >= 3 and documents / n <= 0.3""")
def mail_classifier_terms(spark, d):
    """The classifier's dictionary, and whether the loss is stationary in each term's weight."""
    rows = corpus(spark, d, "tokens")
    model = TermClassifier.fit(rows, "doc_id", "tokens", "toxic")
    slopes = model.slopes(rows, "doc_id", "tokens", "toxic")
    return rounded(slopes.select("token", "documents", "idf", (F.abs("slope") < 1e-6).alias("at_optimum")))


@query("label_models_report")
def label_models_report(spark, d):
    train, test = balance.random_split(corpus(spark, d, "words"), "doc_id", 0.3)
    train = written(train, "train")
    weights = {r["label"]: r["weight"] or 1.0 for r in class_weights(train, LABELS).collect()}
    model = classify.fit_label_models(train, "words", weights)
    flags = classify.label_flags(model, test, LABELS)
    entries = F.array(*[F.struct(F.lit(c).alias("label"), F.col(c).alias("y"), F.col(f"{c}_flag").alias("predicted")) for c in LABELS])
    return rounded(evaluate.label_report(flags.select(F.inline(entries))))


@query("saved_label_models")
def saved_label_models(spark, d):
    rows = corpus(spark, d, "words")
    model = classify.fit_label_models(rows, "words", {"toxic": 4.0, "quality": 1.0})
    path = fresh_path(spark, "model")
    save_model(model, path, {"toxic": 0.4, "quality": 0.6}, spark)
    loaded, thresholds = load_model(path, spark)
    return classify.label_flags(loaded, rows.select("doc_id", "words"), LABELS, thresholds).drop("words")


def vectors_by_label(spark, d):
    return load_spread(spark, d, "embeddings", "vec_id").withColumn("y", (F.col("label") >= 5).cast("int"))


def _agreement(flags, thresholds, *keep):
    """One row per document and label: whether the flag is 1 exactly where the score is above the label's threshold."""
    entries = F.array(*[F.struct(
        F.lit(c).alias("label"), ((F.col(f"s_{c}") > thresholds[c]).cast("int") == F.col(f"{c}_flag")).alias("agrees")) for c in LABELS])
    return flags.select("doc_id", *keep, F.inline(entries))


@query("flags_of_saved_models", """select doc_id, unnest(['quality', 'toxic']) as label, true as agrees, true as same_score
from documents join labels using (doc_id)""")
def flags_of_saved_models(spark, d):
    """Scores and flags of a model that was saved and loaded, against its own thresholds and the model before saving."""
    rows, limits = corpus(spark, d, "words"), {"toxic": 0.4, "quality": 0.6}
    model = classify.fit_label_models(rows, "words", {"toxic": 4.0, "quality": 1.0})
    path = fresh_path(spark, "model")
    save_model(model, path, limits, spark)
    loaded, thresholds = load_model(path, spark)
    before = classify.label_flags(model, rows.select("doc_id", "words"), LABELS, limits).select(
        F.col("doc_id").alias("_doc"), *[F.col(f"s_{c}").alias(f"_{c}") for c in LABELS])
    after = classify.label_flags(loaded, rows.select("doc_id", "words"), LABELS, thresholds)
    same = F.lit(True)
    for c in LABELS:
        same = same & (F.col(f"s_{c}") == F.col(f"_{c}"))
    joined = after.join(before, F.col("doc_id") == F.col("_doc")).withColumn("same_score", same)
    return _agreement(joined, limits, "same_score")


@query("linear_svm_confusion")
def linear_svm_confusion(spark, d):
    train, test = balance.random_split(vectors_by_label(spark, d), "vec_id", 0.2)
    return evaluate.confusion(margins.fit(train, "embedding", "y").apply(test, "embedding"))


@query("linear_svm_optimum", """select unnest(range(max(len(embedding)) + 1)) as feature, true as at_optimum from embeddings""")
def linear_svm_optimum(spark, d):
    """Whether the squared hinge loss is stationary in each weight (the last one is the intercept), from the weights alone."""
    rows = vectors_by_label(spark, d).filter("label is not null")
    model = margins.fit(rows, "embedding", "y")
    weights = [*model.coefficients.tolist(), model.intercept]
    x = F.concat(F.col("embedding").cast("array<double>"), F.array(F.lit(1.0)))
    score = F.aggregate(F.zip_with(x, F.lit(weights), lambda a, b: a * b), F.lit(0.0), lambda total, v: total + v)
    sign = F.when(F.col("y") == 1, 1.0).otherwise(-1.0)
    pull = rows.select(F.posexplode(x).alias("feature", "x"), sign.alias("sign"), score.alias("score")).groupBy("feature").agg(
        F.sum(-2 * F.col("sign") * F.col("x") * F.greatest(1 - F.col("sign") * F.col("score"), F.lit(0.0))).alias("pull"))
    slope = F.col("pull") + F.element_at(F.lit(weights), F.col("feature") + 1)
    return pull.select(F.col("feature").cast("long").alias("feature"), (F.abs(slope) < 1e-5).alias("at_optimum"))


def junk(spark, d):
    """Documents that are toxic or of low quality."""
    return corpus(spark, d, "tokens").filter("toxic = 1 or quality = 0")


def topic_model(spark, d, k):
    return topics.fit_topics(junk(spark, d), "tokens", k)


@query("topic_leading_terms")
def topic_leading_terms(spark, d):
    return rounded(topics.leading_terms(*topic_model(spark, d, 5)))


@query("topic_mean_distance")
def topic_mean_distance(spark, d):
    return rounded(topics.mean_distance(topics.topic_vectors(topic_model(spark, d, 5)[1])))


JUNK = f"""{MAILS}, c as (select doc_id, tokens from m join labels using (doc_id) where toxic = 1 or quality = 0),
t as (select doc_id, unnest(tokens) as token from c), g as (select token, count(distinct doc_id) as documents from t group by 1)"""


@query("ten_topics", f"""with {JUNK} select cast(topic as integer) as topic,
  (select count(*) from g where documents >= 3 and documents <= 0.25 * (select count(*) from c)) as terms, 1::double as total
from range(10) as r(topic)""")
def ten_topics(spark, d):
    """Every topic is a distribution over the whole dictionary."""
    vectors = topics.topic_vectors(topic_model(spark, d, 10)[1])
    return rounded(vectors.groupBy(F.col("vector").alias("topic")).agg(
        F.count(F.lit(1)).alias("terms"), F.sum("weight").alias("total")))


@query("ten_topics_leading_terms", f"""with {JUNK} select topic, position, true as known
from range(10) as r(topic), range(10) as s(position)""")
def ten_topics_leading_terms(spark, d):
    """Ten leading terms of each topic, and whether they are in the dictionary."""
    rows = junk(spark, d)
    leading = topics.leading_terms(*topics.fit_topics(rows, "tokens", 10))
    known = rows.select(F.explode("tokens").alias("term")).distinct().withColumn("known", F.lit(True))
    return leading.join(known, "term", "left").select(
        F.col("topic").cast("long").alias("topic"), F.col("position").cast("long").alias("position"),
        F.coalesce("known", F.lit(False)).alias("known"))


CENTRES = """c as (select label, i, avg(cast(v as double)) as w from (select label, unnest(embedding) as v,
  unnest(range(len(embedding))) as i from embeddings) group by 1, 2), n as (select label, sqrt(sum(w * w)) as n from c group by 1),
d as (select a.label as la, b.label as lb, sum(a.w * b.w) as dot from c a join c b on a.i = b.i and a.label < b.label group by 1, 2),
p as (select x.label as first, y.label as second, 1 - coalesce(dot, 0) / (x.n * y.n) as distance
  from n x join n y on x.label < y.label left join d on la = x.label and lb = y.label)"""


@query("centroid_distances", f"with {CENTRES} select first, second, round(distance, 6) as distance from p")
def centroid_distances(spark, d):
    return rounded(topics.cosine_distances(topics.centroids(load_spread(spark, d, "embeddings", "vec_id"), "label", "embedding")))


@query("mean_centroid_distance", f"with {CENTRES} select round(avg(distance), 6) as mean_distance from p")
def mean_centroid_distance(spark, d):
    return rounded(topics.mean_distance(topics.centroids(load_spread(spark, d, "embeddings", "vec_id"), "label", "embedding")))


@query("streamed_comment_flags")
def streamed_comment_flags(spark, d):
    model = classify.fit_label_models(corpus(spark, d, "words"), "words", {"toxic": 4.0, "quality": 1.0})
    stream = runs.table_stream(spark, d, "documents").select("doc_id", "text")
    return scoring.flag_available(stream, "text", model, LABELS).drop("text")


@query("streamed_flags_agree", """select doc_id, unnest(['quality', 'toxic']) as label, true as agrees, true as same_score
from documents where text is not null""")
def streamed_flags_agree(spark, d):
    """Flags of the stream, in several batches, against their scores and against scoring all documents at once."""
    model = classify.fit_label_models(corpus(spark, d, "words"), "words", {"toxic": 4.0, "quality": 1.0})
    documents = load(spark, d, "documents").filter("text is not null").select("doc_id", "text")
    streamed = scoring.flag_available(runs.ordered_stream(documents, "doc_id", batches=3, largest=20_000), "text", model, LABELS)
    whole = scoring.flag_comments(documents, "text", model, LABELS).select(
        F.col("doc_id").alias("_doc"), *[F.col(f"s_{c}").alias(f"_{c}") for c in LABELS])
    same = F.lit(True)
    for c in LABELS:
        same = same & (F.col(f"s_{c}") == F.col(f"_{c}"))
    joined = streamed.join(whole, F.col("doc_id") == F.col("_doc")).withColumn("same_score", same)
    return _agreement(joined, dict.fromkeys(LABELS, 0.5), "same_score")

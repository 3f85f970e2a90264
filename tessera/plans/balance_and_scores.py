"""Class balance and evaluation on the labelled documents.

The score of a document mixes its label with a hash of its id, so that both engines
compute the same score table.
"""

from pyspark.sql import functions as F

from tessera.operators import balance, evaluate
from tessera.plans.registry import query, rounded
from tessera.session import load

LABELS = ["quality", "toxic"]


def labelled(spark, d):
    return load(spark, d, "labels").select("doc_id", "quality", "toxic")


HASHED = "md5(cast(doc_id as varchar) || '|{seed}')"


def _ranked(where="true", by="", seed=42):
    part = f"partition by {by} " if by else ""
    return f"""(select *, row_number() over ({part}order by {HASHED.format(seed=seed)}, doc_id) as r,
  count(*) over ({f'partition by {by}' if by else ''}) as n from labels where {where})"""


@query("random_split", f"""
select doc_id, case when r <= ceil(n * 0.2::double) then 'test' else 'train' end as part from {_ranked()}""")
def random_split(spark, d):
    train, test = balance.random_split(labelled(spark, d), "doc_id", 0.2)
    return train.select("doc_id", F.lit("train").alias("part")).unionByName(test.select("doc_id", F.lit("test").alias("part")))


@query("three_way_split", f"""
with r as (select doc_id, r <= ceil(n * 0.3::double) as held from {_ranked()}),
h as (select doc_id, row_number() over (order by {HASHED.format(seed=43)}, doc_id) as r, count(*) over () as n from r where held)
select doc_id, case when r <= ceil(n * 0.5) then 'test' else 'validation' end as part from h
union all select doc_id, 'train' from r where not held""")
def three_way_split(spark, d):
    parts = balance.three_way_split(labelled(spark, d), "doc_id")
    named = [p.select("doc_id", F.lit(n).alias("part")) for p, n in zip(parts, ("train", "validation", "test"))]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("stratified_split", f"""
select doc_id, toxic, case when r <= floor(n * 0.2::double + 0.5) then 'test' else 'train' end as part from {_ranked(by='toxic')}""")
def stratified_split(spark, d):
    train, test = balance.stratified_split(labelled(spark, d), "doc_id", "toxic", 0.2)
    return train.select("doc_id", "toxic", F.lit("train").alias("part")).unionByName(
        test.select("doc_id", "toxic", F.lit("test").alias("part")))


@query("undersampled_negatives", f"""
select doc_id, quality, toxic from labels where quality + toxic > 0
union all select doc_id, quality, toxic from {_ranked('quality + toxic = 0')} where r <= floor(n * 0.16::double)""")
def undersampled_negatives(spark, d):
    return balance.undersample_negatives(labelled(spark, d), "doc_id", LABELS, 0.16)


@query("oversampled_labels", """
select doc_id, quality, toxic from labels,
  unnest(range(greatest(1, case when toxic = 1 then 4 else 1 end, case when quality = 1 then 2 else 1 end))) as u(i)""")
def oversampled_labels(spark, d):
    return balance.oversample(labelled(spark, d), {"toxic": 4, "quality": 2})


@query("sampled_documents", f"""
select doc_id, source, lang, n_chars from documents order by {HASHED.format(seed=7)}, doc_id limit 100""")
def sampled_documents(spark, d):
    documents = load(spark, d, "documents").select("doc_id", "source", "lang", "n_chars")
    return balance.sample_rows(documents, "doc_id", 100, 7)


def scored(spark, d):
    def mixed(label, start):
        part = F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), start, 6), 16, 10).cast("double") / 16777216.0
        return (part + 0.5 * F.col(label)) / 1.5

    return labelled(spark, d).withColumns({"p_quality": mixed("quality", 1), "p_toxic": mixed("toxic", 7)})


def score_table(spark, d):
    return evaluate.long_scores(scored(spark, d), "doc_id", {"quality": "p_quality", "toxic": "p_toxic"})


def _mixed(label, start):
    return (f"(cast(cast('0x' || substr(md5(cast(doc_id as varchar)), {start}, 6) as bigint) as double) / 16777216.0::double "
            f"+ 0.5::double * {label}) / 1.5::double")


S = f"""s as (select doc_id, 'quality' as label, quality as y, {_mixed('quality', 1)} as p from labels
  union all select doc_id, 'toxic', toxic, {_mixed('toxic', 7)} from labels)"""


@query("thresholded_predictions", f"""with {S}
select doc_id, label, cast(p > 0.5 as integer) as above, cast(p >= case label when 'toxic' then 0.3::double else 0.6::double end as integer) as tuned from s""")
def thresholded_predictions(spark, d):
    limit = F.when(F.col("label") == "toxic", F.lit(0.3)).otherwise(F.lit(0.6))
    return score_table(spark, d).select(
        "doc_id", "label", evaluate.decided(F.col("p"), strict=True).alias("above"),
        evaluate.decided(F.col("p"), limit).alias("tuned"))


@query("confusion_matrix", f"with {S} select label, y, cast(p >= 0.5 as integer) as predicted, count(*) as n from s group by 1, 2, 3")
def confusion_matrix(spark, d):
    rows = score_table(spark, d).withColumn("predicted", evaluate.decided(F.col("p")))
    return evaluate.confusion(rows, by=["label"])


def _ratio_sql(tp, fp, fn):
    return (f"coalesce(({tp}) / nullif(({tp}) + ({fp}), 0), 0) as precision, coalesce(({tp}) / nullif(({tp}) + ({fn}), 0), 0) as recall, "
            f"coalesce(2 * ({tp}) / nullif(2 * ({tp}) + ({fp}) + ({fn}), 0), 0) as f1")


AVERAGES = f"""r as (select class, {_ratio_sql('tp', 'fp', 'fn')}, tp + fn as support from c),
a as (select * from r union all select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from r
union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
  sum(f1 * support) / sum(support), sum(support) from r
union all select 'micro avg', {_ratio_sql('sum(tp)', 'sum(fp)', 'sum(fn)')}, sum(tp + fn) from c)
select class, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, cast(support as bigint) as support from a"""


@query("label_report", f"""with {S}, c as (select label as class, count(*) filter (where y = 1 and p >= 0.5) as tp,
  count(*) filter (where y = 0 and p >= 0.5) as fp, count(*) filter (where y = 1 and p < 0.5) as fn from s group by 1), {AVERAGES}""")
def label_report(spark, d):
    rows = score_table(spark, d).withColumn("predicted", evaluate.decided(F.col("p")))
    return rounded(evaluate.label_report(rows))


@query("class_report", f"""with {S}, e as (select y, cast(p >= 0.5 as integer) as h from s where label = 'toxic'),
k as (select unnest([0, 1]) as k), c as (select cast(k as varchar) as class, count(*) filter (where y = k and h = k) as tp,
  count(*) filter (where y <> k and h = k) as fp, count(*) filter (where y = k and h <> k) as fn from e, k group by k), {AVERAGES}""")
def class_report(spark, d):
    rows = score_table(spark, d).filter("label = 'toxic'").withColumn("predicted", evaluate.decided(F.col("p")))
    return rounded(evaluate.class_report(rows))


@query("exact_match_accuracy", f"""
select round(avg(case when quality = cast({_mixed('quality', 1)} >= 0.5 as integer) and toxic = cast({_mixed('toxic', 7)} >= 0.5 as integer)
  then 1.0 else 0.0 end), 6) as accuracy from labels""")
def exact_match_accuracy(spark, d):
    rows = scored(spark, d).withColumns({
        "quality_hat": evaluate.decided(F.col("p_quality")), "toxic_hat": evaluate.decided(F.col("p_toxic"))})
    return rounded(evaluate.accuracy(rows, {"quality": "quality_hat", "toxic": "toxic_hat"}))


GRID = f"""g as (select unnest([{', '.join(f'{t!r}::double' for t in evaluate.THRESHOLDS)}]) as threshold),
t as (select label, threshold, coalesce(2 * count(*) filter (where y = 1 and p >= threshold)
  / nullif(count(*) filter (where p >= threshold) + count(*) filter (where y = 1), 0), 0) as f1 from s, g group by 1, 2)"""


@query("threshold_scores", f"with {S}, {GRID} select label, threshold, round(f1, 6) as f1 from t")
def threshold_scores(spark, d):
    out = evaluate.threshold_scores(score_table(spark, d))
    return out.withColumn("f1", F.round("f1", 6))


@query("best_thresholds", f"""with {S}, {GRID}, r as (select *, row_number() over (partition by label order by f1 desc, threshold) as r from t)
select label, threshold, round(f1, 6) as f1 from r where r = 1""")
def best_thresholds(spark, d):
    return evaluate.best_thresholds(score_table(spark, d)).withColumn("f1", F.round("f1", 6))


@query("precision_recall_area", f"""with {S}, c as (select label, p, sum(y) as pos, count(*) as n from s group by 1, 2),
k as (select label, pos, sum(pos) over w / sum(n) over w as pr, lag(label) over w as before,
  (sum(pos) over w - pos) / nullif(sum(n) over w - n, 0) as earlier from c window w as (partition by label order by p desc))
select label, round(sum(pos * (pr + coalesce(earlier, pr)) / 2) / sum(pos), 6) as area from k group by 1""")
def precision_recall_area(spark, d):
    return rounded(evaluate.precision_recall_area(score_table(spark, d)))


@query("focal_loss", f"""with {S}, w as (select label, (count(*) - sum(y)) / sum(y) as w from s group by 1)
select label, round(avg(w * (1 - (y * p + (1 - y) * (1 - p))) ** 2 * -(y * ln(q) + (1 - y) * ln(1 - q))), 6) as loss
from (select s.*, least(greatest(p, 1e-7), 1 - 1e-7) as q from s) s join w using (label) group by 1""")
def focal_loss(spark, d):
    scores = score_table(spark, d)
    weights = scores.groupBy("label").agg(((F.count("y") - F.sum("y")) / F.sum("y")).alias("w"))
    loss = evaluate.focal_loss(F.col("y"), F.col("p"), F.col("w"))
    return rounded(scores.join(weights, "label").groupBy("label").agg(F.avg(loss).alias("loss")))

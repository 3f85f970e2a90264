"""Plans of registered queries: no pairing of whole tables, pruned scans, pushed filters."""

import pytest

import __spark_entry__ as entry
from tessera.plans.models import corpus

FOLDER = "/root/testdata/sf0.001"
CHECKED = [
    "customer_features", "star_join_revenue", "panel_ratios", "box_outliers", "brand_pair_rules", "gap_filled_nation_series",
    "tfidf_weights", "padded_sequences", "stratified_split", "threshold_scores", "centroid_distances", "box_overlaps", "sale_totals",
]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_table_is_paired_as_a_whole(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert word not in plan


def test_scans_read_only_the_columns_in_use(spark):
    plan = plan_of(entry.queries()["customer_features"](spark, FOLDER))
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_linestatus:string>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderpriority:string>" in plan


def test_filters_reach_the_files(spark, capsys):
    entry.queries()["filtered_lines"](spark, FOLDER).explain("formatted")
    pushed = next(line for line in capsys.readouterr().out.splitlines() if line.startswith("PushedFilters"))
    assert "GreaterThanOrEqual(l_quantity,45.0)" in pushed and "In(l_returnflag, [" in pushed


def test_tokens_are_computed_once_per_pass(spark):
    plan = plan_of(entry.queries()["token_counts"](spark, FOLDER))
    assert plan.count("regexp_replace(lower(") <= 1


def test_dictionary_of_lemmas_meets_tokens_where_they_are(spark):
    plan = plan_of(entry.queries()["lemmatised_mails"](spark, FOLDER))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_patches_are_cut_without_python(spark):
    assert plan_of(entry.queries()["random_patches"](spark, FOLDER)).count("MapInPandas") == 1


def test_corpus_takes_only_what_is_asked_for(spark):
    assert set(corpus(spark, FOLDER, "words").columns) >= {"doc_id", "words", "toxic"}
    assert not {"tokens", "text"} & set(corpus(spark, FOLDER, "words").columns)

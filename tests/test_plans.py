"""Plan properties that matter at scale, read from explain("formatted")."""
import contextlib
import io

import pytest

import __spark_entry__ as entry
from fundscope.plans import catalog

# These run jobs while being planned (model fits, exact quantiles).
EAGER = set(catalog.SEARCHES) | {"lr_plain", "model_matrix", "lr_optimum", "lr_predict",
         "dt_predict", "rf_predict", "svc_predict", "text_file_round_trip",
         "table_round_trip", "slice_round_trip", "rebalance", "class_balance_rebalanced", "sample_class",
         "vector_index", "describe_goal", "string_index", "standardize",
         "standardize_embeddings", "auc_score", "roc_points", "encoded_features",
         "indexed_features", "json_round_trip", "delimited_round_trip",
         "csv_round_trip", "dt_search", "rf_search", "svc_searched_predict",
         "similar_documents", "segmented_records", "distinct_sketches", "laid_out_tables",
         "inferred_json"}


def plan(spark, sf, name):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        catalog.QUERIES[name](spark, sf).explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - EAGER))
def test_no_cross_or_nested_loop_joins(spark, sf, name):
    text = plan(spark, sf, name)
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_filters_and_pruning_reach_the_scan(spark, sf):
    text = plan(spark, sf, "campaign_features")
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in text
    assert "c_acctbal" not in text            # unused customer column is not read
    flag = plan(spark, sf, "success_by_goal_bin")
    assert "ReadSchema: struct<doc_id:bigint>" in flag   # blurb text pruned away


def test_duplicate_texts_shuffle_digests_not_texts(spark, sf):
    text = plan(spark, sf, "later_duplicates")
    agg_keys = [line for line in text.splitlines() if line.startswith("Keys [1]:")]
    assert agg_keys and all("_digest" in k for k in agg_keys)


def test_record_parsing_adds_no_shuffle(spark, sf):
    # one exchange: grouping documents into batch files; the parse itself is row-local
    assert plan(spark, sf, "assemble_records").count("Exchange hashpartitioning") <= 1
    assert "Exchange" not in plan(spark, sf, "page_flags")

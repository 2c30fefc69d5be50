"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from penmark.operators.clean import clean_corpus
from penmark.operators.curate import curate_posts
from penmark.operators.encode import encode
from penmark.plans import QUERIES, views as v
from penmark.sources import readers as r

NO_PYTHON = sorted(set(QUERIES) - {
    "fit_classifier", "model_families", "select_best_run", "test_accuracy", "train_word_vectors",
    "score_texts", "score_batch", "stream_score", "stream_curate", "registry_sorted", "main_build",
})


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    execution = df._jdf.queryExecution()
    execution.executedPlan().execute().count()
    return execution.executedPlan().toString()


@pytest.mark.parametrize("name", NO_PYTHON)
def test_no_python_and_no_cross_join(name, spark, sf_dir):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "Python" not in text and "ArrowEval" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_unpartitioned_windows_see_chunk_sizes_only(spark, sf_dir):
    for name in ("dense_id", "batch_ids", "split_exact", "seeded_shuffle", "prepare_data", "pad_batch"):
        for window in re.findall(r"Window \[.*", plan(QUERIES[name](spark, sf_dir))):
            # Without partition keys a window shows "windowspecdefinition(<order> ASC"; only
            # the running sum of chunk sizes may do that.
            spec = window.split("windowspecdefinition(")[1]
            first = spec.split(",")[0]
            if " ASC" in first or " DESC" in first:
                assert "sum(_n" in window, window[:300]


def test_scans_read_the_needed_columns(spark, sf_dir):
    text = plan(QUERIES["class_charset"](spark, sf_dir))
    assert "ReadSchema: struct<text:string,lang:string>" in text
    text = plan(QUERIES["posts_by_user"](spark, sf_dir))
    assert "EqualTo(user_id,8)" in text and "TakeOrderedAndProject" in text
    text = plan(QUERIES["split_hash"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint>" in text


def test_curated_read_prunes_columns(spark, sf_dir):
    from penmark.session import fresh_dir

    path = fresh_dir(spark, "plan")
    curate_posts(v.raw_posts(spark, sf_dir)).write.parquet(path)
    text = plan(r.read_curated(spark, path).select("text", "label"))
    assert "ReadSchema: struct<text:string,label:int>" in text


def test_deduplication_is_hash_based_with_a_partial_step(spark, sf_dir):
    text = plan(QUERIES["dedup_keep_first"](spark, sf_dir))
    assert "partial_min_by" in text and "SortAggregate" not in text


def test_cleaning_shares_the_deduplication_shuffle(spark, sf_dir):
    main = v.tweety(spark, sf_dir).withColumnRenamed("doc_id", "text_id")
    assert "ReusedExchange" in final_plan(clean_corpus(main)) or "ReusedQueryStage" in final_plan(clean_corpus(main))


def test_a_large_vocabulary_is_not_broadcast(spark):
    rows = spark.createDataFrame([(1, ["a", "b"])], "text_id BIGINT, tokens ARRAY<STRING>")
    vocab = spark.createDataFrame([("a", 1, 0)], "word STRING, n BIGINT, idx BIGINT")
    hints = lambda df: df._jdf.queryExecution().analyzed().toString().count("ResolvedHint")
    assert hints(encode(rows, vocab, ["text_id"])) == 1
    # Beyond the limit only the bounded table of hot words keeps its hint.
    text = encode(rows, vocab, ["text_id"], broadcast_bytes=0)._jdf.queryExecution().analyzed().toString()
    assert text.count("ResolvedHint") == 1 and "_hot" in text.split("ResolvedHint")[1][:200]


def test_encoding_makes_tokens_once(spark, sf_dir):
    """What pads, numbers and looks up reads stored tokens and splits no text again."""
    for name in ("pad_batch", "vocab_encode", "encode_fixed"):
        plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().lower()
        assert "regexp" not in plan and "rlike" not in plan and "split(" not in plan

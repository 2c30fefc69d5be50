"""Projections, filters, de-duplication, unions and the curation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.functions.ids import POST_SOURCE
from penmark.operators import curate as c
from penmark.operators.clean import clean_corpus, drop_null_text, known_classes
from penmark.operators.dedup import keep_first
from penmark.operators.encode import token_targets
from penmark.operators.positions import chunk_of, dense_ids
from penmark.plans import views as v
from penmark.plans.landing import land_human_csv, land_labelled_csv
from penmark.plans.registry import query, shown, shown_time
from penmark.plans.sql import cleaned, first_of, strip, with_views
from penmark.session import fresh_dir
from penmark.sources import readers as r, sinks as k


@query("norm_text", with_views(f"SELECT pos, {strip('text')} AS text FROM raw_posts", "raw_posts"))
def norm_text(spark, sf_dir):
    return c.normalise_text(v.raw_posts(spark, sf_dir)).select("pos", "text")


@query("nonempty_text", with_views(
    f"SELECT pos, {strip('text')} AS text FROM raw_posts WHERE length({strip('text')}) > 0", "raw_posts"))
def nonempty_text(spark, sf_dir):
    return v.raw_posts(spark, sf_dir).transform(c.normalise_text).transform(c.drop_empty).select("pos", "text")


@query("default_label", with_views("""
    SELECT 'posts' AS kind, pos, coalesce(label, 0) AS label FROM raw_posts
    UNION ALL SELECT 'generated', pos, coalesce(label, 1) FROM raw_generated""", "raw_posts", "raw_generated"))
def default_label(spark, sf_dir):
    posts = c.default_label(v.raw_posts(spark, sf_dir), c.HUMAN).select(F.lit("posts").alias("kind"), "pos", "label")
    made = c.default_label(v.raw_generated(spark, sf_dir), c.GENERATED)
    return posts.unionByName(made.select(F.lit("generated").alias("kind"), "pos", "label"))


@query("canonical_id", with_views("SELECT pos, sha1('twitter::' || text_id) AS text_id FROM raw_posts", "raw_posts"))
def canonical_id(spark, sf_dir):
    return c.assign_canonical_id(v.raw_posts(spark, sf_dir), POST_SOURCE).select("pos", "text_id")


@query("canonical_id_fallback", "SELECT doc_id AS pos, sha1('twitter::' || doc_id) AS text_id FROM documents")
def canonical_id_fallback(spark, sf_dir):
    """Documents have no text_id column, so their ingest position is the original id."""
    rows = v.documents(spark, sf_dir).select(F.col("doc_id").alias("pos"), "text")
    return c.assign_canonical_id(rows, POST_SOURCE).select("pos", "text_id")


@query("optional_columns", with_views("""
    SELECT pos, label, NULL::VARCHAR AS prompt_name, NULL::VARCHAR AS model FROM raw_generated""", "raw_generated"))
def optional_columns(spark, sf_dir):
    rows = c.add_optional(v.raw_generated(spark, sf_dir), {"prompt_name": "string", "model": "string", "label": "int"})
    return rows.select("pos", "label", "prompt_name", "model")


@query("drop_null_text", with_views("SELECT doc_id, text FROM tweety WHERE text IS NOT NULL", "tweety"))
def null_text(spark, sf_dir):
    return drop_null_text(v.tweety(spark, sf_dir)).select("doc_id", "text")


@query("class_filter", with_views("SELECT doc_id, label FROM odd_labels WHERE label IN (0, 1)", "odd_labels"))
def class_filter(spark, sf_dir):
    return known_classes(v.odd_labels(spark, sf_dir)).select("doc_id", "label")


@query("token_targets", with_views(
    "SELECT text_id, array_to_string(tokens, ',') AS tokens, 1 - label AS human_wrote FROM tokens", "tokens"))
def targets(spark, sf_dir):
    return token_targets(v.tokens(spark, sf_dir)).withColumn("tokens", shown(F.col("tokens")))


@query("token_union", with_views(
    "SELECT text_id, array_to_string(tokens, ',') AS tokens, 1 - label AS human_wrote FROM tokens", "tokens"))
def token_union(spark, sf_dir):
    """The human and the generated token table, read apart and put together."""
    rows = token_targets(v.tokens(spark, sf_dir))
    both = rows.where("human_wrote = 1").unionByName(rows.where("human_wrote = 0"))
    return both.withColumn("tokens", shown(F.col("tokens")))


@query("dedup_keep_first", with_views(
    first_of("raw_posts", "text", "pos", "pos, text, user_id, label"), "raw_posts"))
def dedup_keep_first(spark, sf_dir):
    rows = v.raw_posts(spark, sf_dir).select("pos", "text", "user_id", "label")
    return keep_first(rows, ["text"], "pos")


@query("curate_posts", with_views("""
    SELECT pos, text_id, text, user_id, label, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM posts""",
    "posts"))
def curate_posts(spark, sf_dir):
    return c.curate_posts(v.raw_posts(spark, sf_dir)).withColumn("created_at", shown_time(F.col("created_at")))


@query("curate_generated", with_views(
    "SELECT pos, text_id, text, label, prompt_name, model, source FROM generated", "generated"))
def curate_generated(spark, sf_dir):
    return c.curate_generated(v.raw_generated(spark, sf_dir))


def main_sources(spark, sf_dir):
    """The four sources of the main table, in order."""
    return [
        c.placed(c.curate_posts(v.raw_posts(spark, sf_dir))),
        c.placed(c.curate_generated(v.raw_generated(spark, sf_dir))),
        c.placed(v.user_turns(spark, sf_dir)),
        c.placed(v.labelled_corpus(spark, sf_dir)),
    ]


@query("main_union", with_views("""
    SELECT text, label, 0 AS src_ord FROM posts UNION ALL SELECT text, label, 1 FROM generated
    UNION ALL SELECT text, label, 2 FROM user_turns UNION ALL SELECT text, label, 3 FROM labelled_corpus""",
    "posts", "generated", "user_turns", "labelled_corpus"))
def main_union(spark, sf_dir):
    return c.union_sources(main_sources(spark, sf_dir)).select("text", "label", "src_ord")


@query("dense_id", "SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS text_id FROM events")
def dense_id(spark, sf_dir):
    rows = v.table(spark, sf_dir, "events").select("event_id", chunk_of(F.col("event_id")).alias("chunk"))
    return dense_ids(rows, ["event_id"], ["chunk"], "text_id").select("event_id", "text_id")


@query("main_build", with_views("SELECT text, label, text_id FROM main", "main"))
def main_build(spark, sf_dir):
    """Through files: curated Parquet and two CSV corpora in, the main table out and back."""
    root = fresh_dir(spark, "main")
    posts, _ = k.write_curated(c.curate_posts(v.raw_posts(spark, sf_dir)), root, "posts")
    made, _ = k.write_curated(c.curate_generated(v.raw_generated(spark, sf_dir)), root, "generated")
    sources = [
        c.placed(r.read_curated(spark, posts)),
        c.placed(r.read_curated(spark, made)),
        c.placed(r.read_human_csv(spark, land_human_csv(spark, sf_dir))),
        c.placed(r.read_labelled_csv(spark, land_labelled_csv(spark, sf_dir))),
    ]
    path, _ = k.write_curated(c.merge_main(sources), root, "main")
    return spark.read.parquet(path)


PREPARED = f"""
    , first_rows AS (SELECT text_id, label, {cleaned('text')} AS text FROM (
        SELECT *, row_number() OVER (PARTITION BY text ORDER BY text_id) AS rn FROM whole_main WHERE text IS NOT NULL)
        WHERE rn = 1 AND label IN (0, 1)),
    chars AS (SELECT DISTINCT label, unnest(string_split(text, '')) AS ch FROM first_rows),
    unwanted AS (SELECT coalesce(string_agg(ch, ''), '') AS s FROM chars
                 WHERE label = 1 AND ch NOT IN (SELECT ch FROM chars WHERE label = 0))
    SELECT text_id, label,
           CASE WHEN label = 1 THEN translate(text, (SELECT s FROM unwanted), '') ELSE text END AS text FROM first_rows"""


@query("prepare_data", with_views("", "whole_main").rstrip() + PREPARED)
def prepare_data(spark, sf_dir):
    """Curate, merge and clean: from raw records to the table to train on.

    The curated and the main table are written, as each is used more than once.
    """
    root = fresh_dir(spark, "prepare")
    posts, _ = k.write_curated(c.curate_posts(v.raw_posts(spark, sf_dir)), root, "posts")
    made, _ = k.write_curated(c.curate_generated(v.raw_generated(spark, sf_dir)), root, "generated")
    sources = [
        c.placed(r.read_curated(spark, posts)),
        c.placed(r.read_curated(spark, made)),
        c.placed(v.user_turns(spark, sf_dir)),
        c.placed(v.labelled_corpus(spark, sf_dir)),
    ]
    main, _ = k.write_curated(c.merge_main(sources), root, "main")
    return clean_corpus(spark.read.parquet(main).drop("run")).select("text_id", "label", "text")

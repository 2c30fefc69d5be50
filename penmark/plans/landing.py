"""Readers and writers over the given tables, with files round trips in the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark import schemas
from penmark.functions.ids import GENERATED_SOURCE
from penmark.functions.text import is_blank
from penmark.operators import curate as c
from penmark.operators.clean import clean_corpus
from penmark.operators.score import explode_batch, split_block
from penmark.plans import views as v
from penmark.plans.registry import query, shown_time
from penmark.plans.sql import cleaned, strip, with_views
from penmark.session import fresh_dir
from penmark.sources import posts as p, readers as r, sinks as k


def land_human_csv(spark, sf_dir) -> str:
    """The human corpus as a headerless six-column CSV, in the order of its positions."""
    rows = v.human_corpus(spark, sf_dir).orderBy("pos")
    six = rows.select(
        F.lit(0).alias("target"), F.col("pos").cast("string").alias("id"), F.lit("").alias("date"),
        F.lit("NO_QUERY").alias("flag"), F.lit("someone").alias("user"), "text",
    )
    return k.write_human_csv(six, fresh_dir(spark, "human-csv"))


def land_labelled_csv(spark, sf_dir) -> str:
    rows = v.labelled_corpus(spark, sf_dir).orderBy("pos").select("text", "label")
    return k.append_csv(rows, fresh_dir(spark, "labelled-csv"))


@query("src_human_csv", with_views("SELECT text, label FROM human_corpus", "human_corpus"))
def src_human_csv(spark, sf_dir):
    return r.read_human_csv(spark, land_human_csv(spark, sf_dir)).select("text", "label")


@query("src_labelled_csv", with_views("SELECT text, label FROM labelled_corpus", "labelled_corpus"))
def src_labelled_csv(spark, sf_dir):
    return r.read_labelled_csv(spark, land_labelled_csv(spark, sf_dir)).select("text", "label")


@query("src_curated_parquet", with_views("SELECT text, label FROM posts", "posts"))
def src_curated_parquet(spark, sf_dir):
    path, _ = k.write_curated(c.curate_posts(v.raw_posts(spark, sf_dir)), fresh_dir(spark, "curated"), "posts")
    return r.read_curated(spark, path).select("text", "label")


@query("src_token_csv", with_views(f"""
    SELECT '[' || array_to_string(list_transform(tokens, lambda w: '''' || w || ''''), ', ') || ']' AS text,
           1 - label AS human_wrote, CAST(len(tokens) AS INTEGER) AS n_tokens FROM tokens""", "tokens"))
def src_token_csv(spark, sf_dir):
    rows = v.list_literals(spark, sf_dir).select(F.col("text_id").alias("_c0"), "text", "human_wrote")
    path = k.append_csv(rows, fresh_dir(spark, "token-csv"))
    return r.read_token_csv(spark, path).select("text", "human_wrote", F.size("tokens").alias("n_tokens"))


@query("src_records", with_views("""
    SELECT CASE WHEN role <> 'system' THEN conv_id || ':' || turn END AS text_id, text,
           CASE WHEN role = 'assistant' THEN 1 END AS label, NULL::VARCHAR AS model,
           conv_id * 16777216 + turn AS pos FROM conversations"""))
def src_records(spark, sf_dir):
    """Records whose keys differ from row to row: a null field is not written at all."""
    turns = v.table(spark, sf_dir, "conversations")
    ragged = turns.select(
        F.when(F.col("role") != "system", F.concat_ws(":", "conv_id", "turn")).alias("text_id"),
        "text",
        F.when(F.col("role") == "assistant", F.lit(1)).alias("label"),
        v.turn_position().alias("pos"),
    )
    path = fresh_dir(spark, "records")
    ragged.write.option("ignoreNullFields", "true").json(path)
    return r.read_records(spark, path, schemas.RAW_GENERATED).select("text_id", "text", "label", "model", "pos")


@query("placed_records", with_views("""
    SELECT pos, sha1('llm::' || coalesce(given, CAST(pos AS VARCHAR))) AS text_id, text FROM (
        SELECT row_number() OVER (ORDER BY conv_id, turn) - 1 AS pos, text,
               CASE WHEN role <> 'system' THEN conv_id || ':' || turn END AS given FROM conversations)"""))
def placed_records(spark, sf_dir):
    """Records without a position get one from their place in the files; it stands in for a missing id."""
    turns = v.table(spark, sf_dir, "conversations")
    records = turns.orderBy("conv_id", "turn").select(
        F.when(F.col("role") != "system", F.concat_ws(":", "conv_id", "turn")).alias("text_id"), "text")
    path = fresh_dir(spark, "records")
    records.write.json(path)
    placed = r.read_placed_records(spark, path, schemas.RAW_GENERATED)
    return c.assign_canonical_id(placed, GENERATED_SOURCE).select("pos", "text_id", "text")


def _landed(spark, sf_dir):
    """Posts by the users of events, with their original ids."""
    return v.raw_posts(spark, sf_dir).where(~is_blank(F.col("text")))


_RECORD = "text_id, text, user_id, 0 AS label, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at"
_LANDED = f"(SELECT * FROM raw_posts WHERE length({strip('text')}) > 0)"


def _shown_records(df):
    return df.withColumn("created_at", shown_time(F.col("created_at"))).withColumn(
        "text_id", F.col("text_id").cast("bigint")
    )


@query("posts_by_user", with_views(f"""
    SELECT {_RECORD}, 'user_8' AS username, 'Twitter API v2' AS source FROM {_LANDED} WHERE user_id = 8
    ORDER BY raw_posts.created_at DESC, text_id DESC LIMIT 100""".replace("raw_posts.created_at", "created_at"), "raw_posts"))
def posts_by_user(spark, sf_dir):
    return _shown_records(p.posts_by_user(_landed(spark, sf_dir), 8, "user_8", 100))


@query("posts_by_keyword", with_views(f"""
    SELECT {_RECORD}, NULL::VARCHAR AS username, 'Twitter API v2 - Keyword (Tion)' AS source FROM {_LANDED}
    WHERE contains(lower(text), 'tion') ORDER BY created_at DESC, text_id DESC LIMIT 10""", "raw_posts"))
def posts_by_keyword(spark, sf_dir):
    return _shown_records(p.posts_by_keyword(_landed(spark, sf_dir), "Tion", 10))


@query("posts_time_range", with_views(f"""
    SELECT {_RECORD}, NULL::VARCHAR AS username,
        'Twitter API v2 - Time Range (2024-01-01T00:00:00 ~ 2024-01-10T00:00:00)' AS source FROM {_LANDED}
    WHERE contains(lower(text), 'tion') AND created_at >= TIMESTAMP '2024-01-01 00:00:00'
      AND created_at < TIMESTAMP '2024-01-10 00:00:00' ORDER BY created_at DESC, text_id DESC LIMIT 10""", "raw_posts"))
def posts_time_range(spark, sf_dir):
    start, end = "2024-01-01T00:00:00", "2024-01-10T00:00:00"
    return _shown_records(p.posts_in_range(_landed(spark, sf_dir), "tion", start, end, 10))


@query("generated_records", """
    SELECT doc_id, 'gen_' || (k - 1) AS text_id, text, 1 AS label, 'prompt_' || (k - 1) AS prompt_name,
           'gpt-4o-mini' AS model, 0.7::DOUBLE AS temperature
    FROM (SELECT doc_id, unnest(lines) AS text, generate_subscripts(lines, 1) AS k
          FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""")
def generated_records(spark, sf_dir):
    """Each document is a run of the generator, each line one of its texts."""
    runs = v.documents(spark, sf_dir).select("doc_id", F.split("text", "\n").alias("texts"))
    return p.generated_records(runs, "texts", ["doc_id"])


@query("batch_requests", with_views(f"""
    SELECT request_id, index, text, CASE WHEN length({strip('text')}) = 0 THEN 'Empty text provided' END AS error
    FROM batch_rows""", "batch_rows"))
def batch_requests(spark, sf_dir):
    return explode_batch(v.requests(spark, sf_dir), "body", ["request_id"])


@query("batch_lines", f"""
    SELECT doc_id, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS index, unnest(lines) AS text FROM (
        SELECT doc_id, list_filter(string_split({strip("text || chr(10) || ' ' || chr(10) || ' end '")}, chr(10)),
               lambda x: length({strip('x')}) > 0) AS lines FROM documents)""")
def batch_lines(spark, sf_dir):
    """Every document is a block of lines, with a blank line before the last one."""
    blocks = v.documents(spark, sf_dir).select("doc_id", F.concat("text", F.lit("\n \n end ")).alias("block"))
    return split_block(blocks, "block", ["doc_id"])


@query("curated_roundtrip", with_views("""
    SELECT pos, text_id, text, user_id, label, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at,
           '20240131T000000Z' AS run FROM posts""", "posts"))
def curated_roundtrip(spark, sf_dir):
    root = fresh_dir(spark, "curated")
    k.write_curated(c.curate_posts(v.raw_posts(spark, sf_dir)), root, "posts", "20240131T000000Z")
    back = spark.read.parquet(f"{root}/curated/posts")
    return back.withColumn("created_at", shown_time(F.col("created_at")))


@query("csv_append_roundtrip", with_views("""
    SELECT text, label, count(*) AS copies FROM (
        SELECT text, label FROM posts UNION ALL SELECT text, label FROM labelled_corpus) GROUP BY text, label""",
    "posts", "labelled_corpus"))
def csv_append_roundtrip(spark, sf_dir):
    """Two appends to one table, then a count of what came back."""
    path = fresh_dir(spark, "append-csv")
    k.append_csv(c.curate_posts(v.raw_posts(spark, sf_dir)).select("text", "label"), path)
    k.append_csv(v.labelled_corpus(spark, sf_dir).select("text", "label"), path)
    back = r.read_labelled_csv(spark, path)
    return back.groupBy("text", "label").agg(F.count(F.lit(1)).alias("copies"))


CLEAN_BODY = f"""
    , first_rows AS (SELECT doc_id, label, {cleaned('text')} AS text FROM (
        SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM tweety WHERE text IS NOT NULL)
        WHERE rn = 1 AND label IN (0, 1)),
    chars AS (SELECT DISTINCT label, unnest(string_split(text, '')) AS ch FROM first_rows),
    unwanted AS (SELECT coalesce(string_agg(ch, ''), '') AS s FROM chars
                 WHERE label = 1 AND ch NOT IN (SELECT ch FROM chars WHERE label = 0))
    SELECT doc_id AS text_id, label,
           CASE WHEN label = 1 THEN translate(text, (SELECT s FROM unwanted), '') ELSE text END AS text FROM first_rows"""


def cleaned_tweety(spark, sf_dir):
    return clean_corpus(v.tweety(spark, sf_dir).withColumnRenamed("doc_id", "text_id"))


@query("clean_save_roundtrip", with_views("", "tweety").rstrip() + CLEAN_BODY)
def clean_save_roundtrip(spark, sf_dir):
    path = k.write_cleaned(cleaned_tweety(spark, sf_dir), fresh_dir(spark, "cleaned"), "parquet")
    return spark.read.parquet(path)


@query("curate_counts", with_views(f"""
    SELECT stage, label, count(*) AS records FROM (
        SELECT 'raw' AS stage, label FROM raw_posts
        UNION ALL SELECT 'curated', label FROM posts
        UNION ALL SELECT 'generated', label FROM generated) GROUP BY stage, label""",
    "raw_posts", "posts", "generated"))
def curate_counts(spark, sf_dir):
    raw = v.raw_posts(spark, sf_dir)
    return c.stage_counts({
        "raw": raw, "curated": c.curate_posts(raw), "generated": c.curate_generated(v.raw_generated(spark, sf_dir)),
    })

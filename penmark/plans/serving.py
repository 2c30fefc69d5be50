"""Scoring of texts and requests, batch and streaming."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.functions import tokens as tk
from penmark.operators import score as s
from penmark.plans import views as v
from penmark.plans.encoding import MEANS, WRAPPED, full_vocab
from penmark.plans.registry import query, rounded, shown_time
from penmark.plans.scoring import BIASES, SQL_WEIGHTS, WEIGHTS
from penmark.plans.sql import encoded, rounded as sql_rounded, strip, with_views, words
from penmark.session import fresh_dir
from penmark.streaming.curate import arrive, curate_stream, deliver, read_curated_stream
from penmark.streaming.serve import score_stream


def linear_text_scorer(vocab, vectors, keys):
    """Texts -> mean word vector -> fixed linear layer. Known words share the given vectors, by their index modulo the number of vectors.

    Vocabulary, vectors and layer are joined and stored here, once; what is returned starts no job of its own."""
    total = vectors.agg(F.count(F.lit(1))).scalar()
    turned = vocab.select("word", "n", (F.col("idx") % total + 1).cast("int").alias("idx"))
    logits = s.word_logits(turned, vectors, WEIGHTS, BIASES)

    def run(rows):
        tokens = rows.select(*keys, tk.tokenize(F.col("text")).alias("tokens"))
        return s.score_words(tokens, logits, keys).drop("z0", "z1")

    return run


_LINEAR = f"""
    vecs AS (SELECT vec_id + 1 AS idx, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
    placed AS (SELECT text_id, {WRAPPED} AS idx FROM (SELECT text_id, unnest(ids) AS idx FROM enc))
    {MEANS},
    z AS (SELECT text_id, sum(mean * ({SQL_WEIGHTS[0]})[d]) + 0.05::DOUBLE AS z0,
                 sum(mean * ({SQL_WEIGHTS[1]})[d]) - 0.05::DOUBLE AS z1 FROM sums GROUP BY text_id)"""
_PREDICTION = "CASE WHEN z1 > z0 THEN 1 ELSE 0 END"
_LABEL = "CASE WHEN z1 > z0 THEN 'Human-Written' ELSE 'AI-Generated' END"
_CONFIDENCE = sql_rounded("1 / (exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1)))")


@query("scored_json", with_views("", "turns", "full_vocab").rstrip() + f"""
    , good AS (SELECT text_id, text, {words('text')} AS tokens FROM turns),
    enc AS ({encoded('good', 'full_vocab', 'text_id')}), {_LINEAR}
    SELECT text_id, CAST(json_object('index', text_id, 'text', text, 'prediction', {_PREDICTION},
        'confidence', {_CONFIDENCE}, 'label', {_LABEL}) AS VARCHAR) AS json FROM z JOIN good USING (text_id)""")
def scored_json(spark, sf_dir):
    """Every conversation turn as the JSON a client would get."""
    turns = v.turns(spark, sf_dir).drop("role")
    scorer = linear_text_scorer(full_vocab(spark, sf_dir), v.word_vectors(spark, sf_dir), ["text_id"])
    # The texts join their scores again at the end: as a key they would be repeated per token.
    scored = scorer(turns).join(turns, "text_id").withColumn("index", F.col("text_id"))
    shown = scored.withColumn("confidence", rounded(F.col("confidence")))
    return s.as_json(shown, ["index", "text", "prediction", "confidence", "label"], ["text_id"])


_SCORED_ROWS = f"""
    , good AS (SELECT request_id * 100000 + index AS text_id, request_id, index, {words('text')} AS tokens
               FROM batch_rows WHERE length({strip('text')}) > 0),
    enc AS ({encoded('good', 'full_vocab', 'text_id')}), {_LINEAR}
    SELECT request_id, index, {_PREDICTION} AS prediction, {_LABEL} AS label, {_CONFIDENCE} AS confidence
    FROM z JOIN good USING (text_id)"""


@query("stream_score", with_views("", "batch_rows", "full_vocab").rstrip() + _SCORED_ROWS)
def stream_score(spark, sf_dir):
    """Requests arrive as files of bodies and are scored as they do."""
    landing = fresh_dir(spark, "requests")
    v.requests(spark, sf_dir).write.parquet(landing)
    arriving = spark.readStream.schema("request_id BIGINT, body STRING").parquet(landing)
    scorer = linear_text_scorer(full_vocab(spark, sf_dir), v.word_vectors(spark, sf_dir), ["request_id", "index"])
    out = fresh_dir(spark, "scored")
    score_stream(arriving, scorer, out, fresh_dir(spark, "score-stream")).awaitTermination()
    scored = spark.read.schema(
        "request_id BIGINT, index INT, prediction INT, confidence DOUBLE, label STRING, batch INT"
    ).parquet(f"{out}/scored")
    return scored.select("request_id", "index", "prediction", "label", rounded(F.col("confidence")).alias("confidence"))


@query("stream_curate", with_views(
    "SELECT text_id, text, user_id, label, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at FROM posts", "posts"))
def stream_curate(spark, sf_dir):
    """Three deliveries, days out of order; the last repeats some posts of the first."""
    posts = v.raw_posts(spark, sf_dir)
    day = F.dayofmonth("created_at") % 3
    staged, landing, out, checkpoint = (fresh_dir(spark, name) for name in ("staged", "posts", "stream-posts", "curate-stream"))
    deliver(posts, [day == 2, day == 0, (day == 1) | (F.col("pos") % 7 == 0)], staged)
    for i in range(3):
        arrive(spark, f"{staged}/delivery={i}", f"{landing}/{i}")
        arriving = spark.readStream.schema(posts.schema).option("recursiveFileLookup", "true").parquet(landing)
        curate_stream(arriving, out, checkpoint).awaitTermination()
    rows = read_curated_stream(spark, out).withColumn("created_at", shown_time(F.col("created_at")))
    return rows.select("text_id", "text", "user_id", "label", "created_at")

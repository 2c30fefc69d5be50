"""Logits to classes, accuracy, losses and request validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.functions import scoring as sc
from penmark.operators import score as s
from penmark.plans import views as v
from penmark.plans.registry import query, rounded
from penmark.plans.sql import rounded as sql_rounded, strip, with_views
from penmark.plans.encoding import DIMS


def logit_arrays(spark, sf_dir):
    return v.logits(spark, sf_dir).withColumn("z", F.array("z0", "z1"))


@query("softmax", with_views(
    f"SELECT vec_id, {sql_rounded('p0')} AS p0, {sql_rounded('p1')} AS p1 FROM softmax", "softmax"))
def softmax(spark, sf_dir):
    p = logit_arrays(spark, sf_dir).withColumn("p", sc.softmax(F.col("z")))
    return p.select("vec_id", rounded(F.col("p")[0]).alias("p0"), rounded(F.col("p")[1]).alias("p1"))


@query("argmax", "SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS prediction FROM embeddings")
def argmax(spark, sf_dir):
    return v.table(spark, sf_dir, "embeddings").select("vec_id", sc.argmax(F.col("embedding")).alias("prediction"))


@query("confidence", with_views(
    f"SELECT vec_id, {sql_rounded('greatest(p0, p1)')} AS confidence FROM softmax", "softmax"))
def confidence(spark, sf_dir):
    return logit_arrays(spark, sf_dir).select("vec_id", rounded(sc.confidence(F.col("z"))).alias("confidence"))


_CLASS = "CASE WHEN z1 > z0 THEN 'Human-Written' ELSE 'AI-Generated' END"


@query("decode_label", with_views(f"SELECT vec_id, {_CLASS} AS label FROM logits", "logits"))
def decode_label(spark, sf_dir):
    return logit_arrays(spark, sf_dir).select("vec_id", sc.class_name(sc.argmax(F.col("z"))).alias("label"))


@query("confidence_pct", with_views(
    "SELECT vec_id, printf('%.1f%%', greatest(p0, p1) * 100) AS shown FROM softmax", "softmax"))
def confidence_pct(spark, sf_dir):
    return logit_arrays(spark, sf_dir).select("vec_id", sc.percent(sc.confidence(F.col("z"))).alias("shown"))


@query("accuracy", with_views(f"""
    SELECT CAST(sum(hit) AS BIGINT) AS correct, count(*) AS total, {sql_rounded('avg(hit)')} AS accuracy
    FROM (SELECT CASE WHEN (z1 > z0) = (target = 1) THEN 1 ELSE 0 END AS hit FROM logits)""", "logits"))
def accuracy(spark, sf_dir):
    scored = s.decide(v.logits(spark, sf_dir))
    return s.accuracy(scored).withColumn("accuracy", rounded(F.col("accuracy")))


@query("cross_entropy", with_views(f"""
    SELECT vec_id // 64 AS batch_id, count(*) AS n,
        {sql_rounded("avg(ln(exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1))) + greatest(z0, z1) - CASE target WHEN 0 THEN z0 ELSE z1 END)")} AS loss
    FROM logits GROUP BY vec_id // 64""", "logits"))
def cross_entropy(spark, sf_dir):
    rows = logit_arrays(spark, sf_dir).select(
        F.floor(F.col("vec_id") / 64).alias("batch_id"), sc.cross_entropy(F.col("z"), F.col("target")).alias("loss")
    )
    return rows.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg("loss")).alias("loss"))


# A fixed linear layer, given by a rule.
WEIGHTS = [[((i * 37) % 11 - 5) / 10 for i in range(1, DIMS + 1)], [((i * 53) % 13 - 6) / 10 for i in range(1, DIMS + 1)]]
BIASES = [0.05, -0.05]

SQL_WEIGHTS = (
    "list_transform(range(1, 65), lambda i: ((i * 37) % 11 - 5) / 10::DOUBLE)",
    "list_transform(range(1, 65), lambda i: ((i * 53) % 13 - 6) / 10::DOUBLE)",
)


@query("score_linear", f"""
    SELECT vec_id, CASE WHEN z1 > z0 THEN 1 ELSE 0 END AS prediction, {_CLASS} AS label,
        {sql_rounded('exp(greatest(z0, z1) - greatest(z0, z1)) / (exp(z0 - greatest(z0, z1)) + exp(z1 - greatest(z0, z1)))')} AS confidence
    FROM (SELECT vec_id, list_dot_product(CAST(embedding AS DOUBLE[]), {SQL_WEIGHTS[0]}) + 0.05::DOUBLE AS z0,
                 list_dot_product(CAST(embedding AS DOUBLE[]), {SQL_WEIGHTS[1]}) - 0.05::DOUBLE AS z1 FROM embeddings)""")
def score_linear(spark, sf_dir):
    rows = v.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    scored = s.linear_scores(rows, "embedding", WEIGHTS, BIASES)
    return scored.select("vec_id", "prediction", "label", rounded(F.col("confidence")).alias("confidence"))


@query("request_validation", with_views(f"""
    SELECT request_id,
        CASE WHEN NOT json_valid(body) THEN 'Prediction failed'
             WHEN NOT list_contains(json_keys(body), 'text') THEN 'No text provided'
             WHEN json_type(body, '$.text') <> 'VARCHAR' THEN 'Prediction failed'
             WHEN length({strip("json_extract_string(body, '$.text')")}) = 0 THEN 'Empty text provided' END AS single_error,
        CASE WHEN NOT json_valid(body) THEN 'Batch prediction failed'
             WHEN NOT list_contains(json_keys(body), 'texts') THEN 'No texts provided'
             WHEN json_type(body, '$.texts') <> 'ARRAY' OR json_array_length(body, '$.texts') = 0
             THEN 'Invalid texts format' END AS batch_error
    FROM requests""", "requests"))
def request_validation(spark, sf_dir):
    return v.requests(spark, sf_dir).select(
        "request_id", s.single_error(F.col("body")).alias("single_error"), s.batch_error(F.col("body")).alias("batch_error")
    )

"""Tokens, vocabulary, index encoding, batches, shuffles and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from penmark.functions import tokens as tk
from penmark.operators import encode as e
from penmark.operators.positions import batches, seeded_order
from penmark.operators.split import split_by_hash, split_exact
from penmark.plans import views as v
from penmark.plans.registry import query, rounded, shown
from penmark.plans.sql import encoded, rounded as sql_rounded, with_views, words
from penmark.session import materialise

MIN_COUNT = 1  # the queries encode with all words
DIMS = 64  # of the given embeddings


def full_vocab(spark, sf_dir, tokens=None):
    return e.build_vocab(v.tokens(spark, sf_dir) if tokens is None else tokens, min_count=MIN_COUNT)


def stored_tokens(spark, sf_dir):
    """The token table, made once for the readers that an encoding query has."""
    return materialise(v.tokens(spark, sf_dir))


def encoded_tokens(spark, sf_dir, tokens=None):
    tokens = stored_tokens(spark, sf_dir) if tokens is None else tokens
    return e.encode(tokens, full_vocab(spark, sf_dir, tokens), ["text_id", "label"])


@query("parse_token_list", with_views(
    "SELECT text_id, array_to_string(tokens, ' ') AS tokens, CAST(len(tokens) AS INTEGER) AS n FROM tokens", "tokens"))
def parse_token_list(spark, sf_dir):
    parsed = tk.parse_list_literal(F.col("text"))
    rows = v.list_literals(spark, sf_dir).select("text_id", parsed.alias("tokens"))
    return rows.select("text_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n"))


@query("tokenize_ws", with_views(f"""
    SELECT doc_id, array_to_string(t, ' ') AS tokens, CAST(len(t) AS INTEGER) AS n
    FROM (SELECT doc_id, {words('text')} AS t FROM tweety WHERE text IS NOT NULL)""", "tweety"))
def tokenize_ws(spark, sf_dir):
    rows = v.tweety(spark, sf_dir).where("text IS NOT NULL").select("doc_id", tk.tokenize(F.col("text")).alias("t"))
    return rows.select("doc_id", F.array_join("t", " ").alias("tokens"), F.size("t").alias("n"))


@query("alpha_tokens", with_views(
    "SELECT text_id, array_to_string(tokens, ' ') AS tokens, CAST(len(tokens) AS INTEGER) AS n FROM tokens", "tokens"))
def alpha_tokens(spark, sf_dir):
    rows = v.tokens(spark, sf_dir)
    return rows.select("text_id", F.array_join("tokens", " ").alias("tokens"), F.size("tokens").alias("n"))


@query("vocab_min_count", with_views("SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS idx FROM vocab WHERE n >= 5", "vocab"))
def vocab_min_count(spark, sf_dir):
    """A vocabulary without words that occur fewer than five times."""
    return e.build_vocab(v.tokens(spark, sf_dir), min_count=5).select("word", "idx")


@query("build_vocab", with_views("SELECT word, n, idx FROM vocab", "vocab"))
def build_vocab(spark, sf_dir):
    return e.build_vocab(v.tokens(spark, sf_dir))


@query("vocab_size", with_views("SELECT count(*) + 1 AS vocab_size FROM full_vocab", "full_vocab"))
def vocab_size(spark, sf_dir):
    return e.vocab_size(full_vocab(spark, sf_dir))


_ENCODED = "SELECT text_id, label, array_to_string(ids, ',') AS ids FROM encoded"


def _shown_ids(df):
    return df.withColumn("ids", shown(F.col("ids")))


@query("vocab_encode", with_views(_ENCODED, "encoded"))
def vocab_encode(spark, sf_dir):
    return _shown_ids(encoded_tokens(spark, sf_dir))


@query("encode_train", with_views(
    "SELECT text_id, 1 - label AS human_wrote, array_to_string(ids, ',') AS ids FROM encoded", "encoded"))
def encode_train(spark, sf_dir):
    rows = v.list_literals(spark, sf_dir)
    return _shown_ids(e.encode_for_training(rows, full_vocab(spark, sf_dir), ["text_id", "human_wrote"]))


@query("encode_serve", with_views("", "turns", "full_vocab").rstrip() + f"""
    , served AS (SELECT text_id, {words('text')} AS tokens FROM turns),
    enc AS ({encoded('served', 'full_vocab', 'text_id')})
    SELECT text_id, array_to_string(ids, ',') AS ids FROM enc""")
def encode_serve(spark, sf_dir):
    return _shown_ids(e.encode_for_serving(v.turns(spark, sf_dir), full_vocab(spark, sf_dir), ["text_id"]))


@query("encode_fixed", with_views("""
    SELECT text_id, label,
        array_to_string(list_concat(ids[1:128], list_transform(range(128 - least(len(ids), 128)), lambda i: 0)), ',') AS input_ids,
        array_to_string(list_transform(range(128), lambda i: CASE WHEN i < len(ids) THEN 1 ELSE 0 END), ',') AS attention_mask
    FROM encoded""", "encoded"))
def encode_fixed(spark, sf_dir):
    tokens = stored_tokens(spark, sf_dir)
    first = tokens.withColumn("tokens", F.slice("tokens", 1, tk.FIXED_LENGTH))  # no more is kept
    rows = e.fixed_samples(e.encode(first, full_vocab(spark, sf_dir, tokens), ["text_id", "label"]))
    return rows.select("text_id", "label", shown(F.col("input_ids")).alias("input_ids"),
                       shown(F.col("attention_mask")).alias("attention_mask"))


@query("encoded_lengths", with_views("""
    SELECT label, count(*) AS samples, CAST(sum(len(ids)) AS BIGINT) AS tokens, CAST(max(len(ids)) AS INTEGER) AS longest
    FROM encoded GROUP BY label""", "encoded"))
def encoded_lengths(spark, sf_dir):
    return encoded_tokens(spark, sf_dir).groupBy("label").agg(
        F.count(F.lit(1)).alias("samples"), F.sum(F.size("ids")).alias("tokens"), F.max(F.size("ids")).alias("longest")
    )


@query("pad_batch", with_views("""
    SELECT text_id, batch_id, CAST(longest AS INTEGER) AS longest, md5(array_to_string(list_concat(ids, list_transform(range(longest - len(ids)), lambda i: 0)), ',')) AS padded
    FROM (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS longest FROM (
        SELECT *, (row_number() OVER (ORDER BY text_id) - 1) // 314 AS batch_id FROM encoded))""", "encoded"))
def pad_batch(spark, sf_dir):
    tokens = stored_tokens(spark, sf_dir)
    sizes = tokens.select("text_id", F.size("tokens").alias("n"))  # encoding keeps the length
    rows = e.pad_batches(encoded_tokens(spark, sf_dir, tokens), "text_id", 314, sizes)
    return rows.select("text_id", "batch_id", "longest", F.md5(shown(F.col("ids"))).alias("padded"))


@query("batch_ids", "SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 314 AS batch_id FROM events")
def batch_ids(spark, sf_dir):
    return batches(v.table(spark, sf_dir, "events").select("event_id"), "event_id", 314)


def wrapped(rows, vectors):
    """Known words share the given vectors, by their index modulo the number of vectors."""
    total = vectors.agg(F.count(F.lit(1)).cast("int")).scalar()
    turned = F.transform("ids", lambda i: F.when(i > 0, (i - 1) % F.col("_total") + 1).otherwise(i))
    return rows.withColumn("_total", total).withColumn("ids", turned).drop("_total")


WRAPPED = "CASE WHEN idx > 0 THEN (idx - 1) % (SELECT count(*) FROM embeddings) + 1 ELSE 0 END"


def turn_ids(spark, sf_dir):
    """Conversation turns as indexes of the given vectors."""
    rows = v.turns(spark, sf_dir).select("text_id", tk.tokenize(F.col("text")).alias("tokens"))
    ids = e.encode(rows, full_vocab(spark, sf_dir), ["text_id"])
    return wrapped(ids, v.word_vectors(spark, sf_dir))


_TURN_IDS = f"""
    , served AS (SELECT text_id, {words('text')} AS tokens FROM turns),
    enc AS ({encoded('served', 'full_vocab', 'text_id')}),
    vecs AS (SELECT vec_id + 1 AS idx, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
    placed AS (SELECT text_id, {WRAPPED} AS idx, place FROM (
        SELECT text_id, unnest(ids) AS idx, generate_subscripts(ids, 1) - 1 AS place FROM enc))"""


@query("embedding_lookup", with_views("", "turns", "full_vocab").rstrip() + _TURN_IDS + f"""
    SELECT text_id, CAST(place AS INTEGER) AS place, idx, {sql_rounded('coalesce(vec[1], 0)')} AS first_dim,
           {sql_rounded('coalesce(list_sum(vec), 0)')} AS total FROM placed LEFT JOIN vecs USING (idx)""")
def embedding_lookup(spark, sf_dir):
    found = e.embed(turn_ids(spark, sf_dir), v.word_vectors(spark, sf_dir), ["text_id"], DIMS)
    total = F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x)
    return found.select("text_id", F.col("at").alias("place"), "idx", rounded(F.col("vec")[0]).alias("first_dim"), rounded(total).alias("total"))


MEANS = f"""
    , sums AS (SELECT text_id, d, sum(coalesce(vec[d], 0)) / count(*) AS mean FROM placed LEFT JOIN vecs USING (idx)
               CROSS JOIN (SELECT unnest(range(1, 65)) AS d) GROUP BY text_id, d)"""


@query("doc_mean_embedding", with_views("", "turns", "full_vocab").rstrip() + _TURN_IDS + MEANS + f"""
    SELECT text_id, CAST(d - 1 AS INTEGER) AS dim, {sql_rounded('mean')} AS mean FROM sums""")
def doc_mean_embedding(spark, sf_dir):
    means = e.mean_embedding(turn_ids(spark, sf_dir), v.word_vectors(spark, sf_dir), ["text_id"], DIMS)
    return means.select("text_id", F.posexplode("mean").alias("dim", "mean")).withColumn("mean", rounded(F.col("mean")))


@query("head_n", "SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 10")
def head_n(spark, sf_dir):
    return v.documents(spark, sf_dir).select("doc_id", "text").orderBy("doc_id").limit(10)


@query("seeded_shuffle", "SELECT doc_id, row_number() OVER (ORDER BY md5('42:' || doc_id)) - 1 AS place FROM documents")
def seeded_shuffle(spark, sf_dir):
    return seeded_order(v.documents(spark, sf_dir).select("doc_id"), "doc_id", "place")


@query("split_hash", """
    SELECT event_id, CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'val' ELSE 'test' END AS split
    FROM (SELECT event_id, CAST('0x' || substr(md5('42:' || event_id), 1, 8) AS BIGINT) % 100 AS b FROM events)""")
def split_hash(spark, sf_dir):
    return split_by_hash(v.table(spark, sf_dir, "events").select("event_id"), "event_id")


@query("split_exact", """
    SELECT event_id, CASE WHEN r < n - held THEN 'train' WHEN r < n - ceil(0.5 * held) THEN 'val' ELSE 'test' END AS split
    FROM (SELECT event_id, row_number() OVER (ORDER BY md5('42:' || event_id)) - 1 AS r, count(*) OVER () AS n,
                 ceil(0.3::DOUBLE * count(*) OVER ()) AS held FROM events)""")
def exact(spark, sf_dir):
    return split_exact(v.table(spark, sf_dir, "events").select("event_id"), "event_id")

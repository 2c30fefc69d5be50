"""Vocabulary, index encoding, padding and embedding lookup."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F, types as T

from penmark.functions import tokens as tk
from penmark.functions.rows import one_per_item
from penmark.operators.lookup import BROADCAST_BYTES, lookup, lookup_arrays
from penmark.operators.positions import batches, positions


def token_targets(df: DataFrame) -> DataFrame:
    """Tokens with the target of training: ``human_wrote`` is the opposite of ``label``."""
    return df.select("text_id", "tokens", (1 - F.col("label")).alias("human_wrote"))


def build_vocab(df: DataFrame, tokens: str = "tokens", min_count: int = 1) -> DataFrame:
    """``word, n, idx``: index 0.. by falling frequency, then by word."""
    counts = (
        one_per_item(df, [], tokens, "word")
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= min_count)
    )
    return positions(counts, [F.desc("n"), F.asc("word")], "idx")


def vocab_size(vocab: DataFrame) -> DataFrame:
    """Number of indexes in use: the words and the padding slot."""
    return vocab.agg((F.count(F.lit(1)) + 1).alias("vocab_size"))


def encode(
    df: DataFrame,
    vocab: DataFrame,
    keys: list[str],
    tokens: str = "tokens",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Replace each token by its index + 1, unknown tokens by 0; order and length stay, no array gives an empty one.

    ``keys`` are kept. Tokens do not move: texts are stored as numbers of the distinct words of their block, which alone are looked up, and
    the arrays are filled in the task of the block.
    """
    weight = "n" if "n" in vocab.columns else None  # the vocabulary knows its frequent words
    table = vocab.select("word", (F.col("idx") + 1).cast("int").alias("id"), *([weight] if weight else []))
    unknown = tk.PAD

    def fill(words: pa.Array, ids: pa.Array, items: pa.Array, counts: np.ndarray) -> pa.Array:
        found = ids.take(pc.index_in(items, value_set=words))
        offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pc.fill_null(found, unknown))

    out = T.StructField("ids", T.ArrayType(T.IntegerType()))
    return lookup_arrays(df, keys, tokens, table, "word", "id", out, fill, broadcast_bytes=broadcast_bytes, weight=weight)


def encode_for_training(df: DataFrame, vocab: DataFrame, keys: list[str], literal: str = "text") -> DataFrame:
    """From stored list literals: parse, keep alphabetic tokens, look up."""
    parsed = df.withColumn("tokens", tk.keep_alpha(tk.parse_list_literal(F.col(literal))))
    return encode(parsed, vocab, keys)


def encode_for_serving(df: DataFrame, vocab: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """From a raw text: split at whitespace and look up; no filter, no cleaning."""
    return encode(df.withColumn("tokens", tk.tokenize(F.col(text))), vocab, keys)


def pad_batches(df: DataFrame, key: str, size: int, sizes: DataFrame | None = None) -> DataFrame:
    """Pad every index array to the longest of its batch. A batch has ``size`` rows.

    Batches are numbered over ``sizes`` (the unique ``key`` and ``n``, the length of its array), read twice, so that no
    array moves before it is padded. Without ``sizes`` they are taken from ``df``: hand in a stored table then.
    """
    if sizes is None:
        sizes = df.select(key, F.size("ids").alias("n"))
    batched = batches(sizes, key, size).select(F.col(key).alias("_key"), "n", "batch_id")
    longest = F.max("n").over(Window.partitionBy("batch_id"))
    places = batched.withColumn("longest", longest).drop("n")
    padded = tk.pad_right(F.col("ids"), F.col("longest"))
    return df.join(places, F.col(key).eqNullSafe(F.col("_key"))).drop("_key").withColumn("ids", padded)


def fixed_samples(df: DataFrame, length: int = tk.FIXED_LENGTH) -> DataFrame:
    """``input_ids`` and ``attention_mask`` of one fixed length."""
    return df.withColumns(
        {
            "input_ids": tk.fixed_ids(F.col("ids"), length),
            "attention_mask": tk.attention_mask(F.col("ids"), length),
        }
    ).drop("ids")


def embed(df: DataFrame, vectors: DataFrame, keys: list[str], dims: int, **options) -> DataFrame:
    """One row per text position with its vector; index 0 and unknown ones are zero.

    ``vectors`` holds ``idx`` (already shifted past the padding slot) and ``vec``.
    """
    rows = one_per_item(df, keys, "ids", "idx", "at")
    found = lookup(rows, vectors, "idx", spread_by=[keys[0], "at"], **options)
    zero = F.array_repeat(F.lit(0.0), dims)
    return found.withColumn("vec", F.coalesce(F.col("vec").cast("array<double>"), zero))


def mean_embedding(
    df: DataFrame, vectors: DataFrame, keys: list[str], dims: int, **options
) -> DataFrame:
    """Mean vector of each text.

    The vectors of a block's distinct indexes are looked up and summed in its task, each by how often a text has it; neither
    positions nor vectors of positions move. A text without tokens has the zero vector.
    """

    def fill(known: pa.Array, vectors: pa.Array, items: pa.Array, counts: np.ndarray) -> pa.Array:
        held = np.zeros((len(known) + 1, dims))
        if len(known):
            held[:-1] = vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(known), dims)
        at = pc.fill_null(pc.index_in(items, value_set=known), len(known)).to_numpy()
        ends = np.cumsum(counts)
        means = np.zeros((len(counts), dims))
        for i, (start, end) in enumerate(zip([0, *ends[:-1].tolist()], ends.tolist())):
            if end > start:
                own, n = np.unique(at[start:end], return_counts=True)
                means[i] = n @ held[own] / (end - start)
        offsets = pa.array(np.arange(0, (len(counts) + 1) * dims, dims, dtype=np.int32))
        return pa.ListArray.from_arrays(offsets, pa.array(means.reshape(-1)))

    table = vectors.select(F.col("idx").cast(df.schema["ids"].dataType.elementType), "vec")
    out = T.StructField("mean", T.ArrayType(T.DoubleType()))
    return lookup_arrays(df, keys, "ids", table, "idx", "vec", out, fill, **options)

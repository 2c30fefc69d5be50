"""Registered queries of the operators: each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from penmark.llm import decontaminate, extract, hmm, nearest, packing, periodic, private, quality, sharding, simhash_dedup, spelling, suffix_dedup, window_dedup
from penmark.llm.common import table


def tokenizer_path() -> str:
    """The public byte-level BPE file that the production queries use."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), keep_ids=False)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % nearest.EVERY == 0)


def op7_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"))


def op8_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.find_runs(table(spark, sf_dir, "documents")).drop("collapsed")


def op13_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return private.find(docs, private.fit(docs)).drop("redacted")


QUERIES = {
    "op1_packing": op1_packing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_extract": op3_extract,
    "op4_decontamination": op4_decontamination,
    "op5_sharding": op5_sharding,
    "op6_nearest": op6_nearest,
    "op7_hmm": op7_hmm,
    "op8_window_dedup": op8_window_dedup,
    "op9_quality": op9_quality,
    "op10_simhash_dedup": op10_simhash_dedup,
    "op11_spelling": op11_spelling,
    "op12_periodic": op12_periodic,
    "op13_private": op13_private,
}

# The other operators rest on fitted models, byte windows, XXH64 or searches that SQL cannot state; tests hold them against brute force.
CHECKS: dict[str, str] = {
    "op8_window_dedup": r"""
        WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
        each AS (SELECT doc_id, len(words) AS n, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM w),
        windows AS (
            SELECT doc_id, p, md5(string_agg(word, ' ') OVER (
                PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS k
            FROM each QUALIFY p <= n - 49),
        hits AS (SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS first FROM windows) WHERE first < doc_id),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM hits),
        kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
            FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(text, '')) AS kept_sha256
        FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id""",
    "op11_spelling": r"""
        WITH RECURSIVE
        bits AS (
            SELECT list_reduce(list_prepend(CAST(b AS BIGINT), range(8)),
                               lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS c, b
            FROM range(256) AS t(b)),
        steps AS (SELECT list(c ORDER BY b) AS crc FROM bits),
        runs AS (
            SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
            WHERE length(run) >= 6 GROUP BY ALL),
        points AS (
            SELECT runs.*, list_transform(string_split(concat(doc_id, ':', run), ''), lambda c: CAST(unicode(c) AS BIGINT)) AS p FROM runs),
        bytes AS (
            SELECT * EXCLUDE p, flatten(list_transform(p, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + c // 64, 128 + c % 64] END)) AS p
            FROM points),
        hashed AS (
            SELECT run, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), p),
                   lambda x, y: xor(x // 256, crc[1 + xor(x % 256, y)]))) AS h
            FROM bytes, steps),
        spelt AS (
            SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed),
        vocab AS (
            SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelt WHERE length(word) >= 6 GROUP BY word HAVING sum(spelt.n) >= 5),
        cuts AS (
            SELECT word, n, i, word[:i - 1] || word[i + 1:] AS cut
            FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
        near AS (
            SELECT a.word, b.word AS other, b.n AS m FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cuts a JOIN vocab b ON a.cut = b.word
            UNION SELECT b.word, a.word, a.n FROM cuts a JOIN vocab b ON a.cut = b.word),
        best AS (SELECT word, count(*) AS n_near, min((-m, other)) AS best FROM near GROUP BY word),
        forms AS (
            SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN -best[1] >= 5 * v.n THEN best[2] END AS form, CASE WHEN -best[1] >= 5 * v.n THEN -best[1] END AS form_n
            FROM vocab v LEFT JOIN best USING (word)),
        chain AS (
            SELECT word, word AS root, form AS further FROM forms
            UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON c.further = f.word)
        SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n
        FROM forms f JOIN chain c ON c.word = f.word AND c.further IS NULL""",
}

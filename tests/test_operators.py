from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from penmark import schemas
from penmark.functions import ids, naming, scoring as sc
from penmark.operators import clean, curate, encode as e, history, registry, score as s, split
from penmark.operators.dedup import keep_first
from penmark.operators.lookup import lookup
from penmark.operators.positions import batches, chunk_of, dense_ids, positions, seeded_order
from penmark.session import fresh_dir, shared_root
from penmark.sources import readers as r, sinks as k


def test_keep_first_takes_the_earliest_label(spark):
    rows = spark.createDataFrame([("x", 1, 5), ("x", 0, 2), ("y", 1, 1), ("x", 1, 9)], "text STRING, label INT, pos BIGINT")
    assert sorted(map(tuple, keep_first(rows, ["text"], "pos").collect())) == [("x", 0, 2), ("y", 1, 1)]


def test_keep_first_with_text_columns(spark):
    rows = spark.createDataFrame([("x", "late", 5), ("x", None, 2)], "text STRING, note STRING, pos BIGINT")
    assert keep_first(rows, ["text"], "pos").collect()[0] == ("x", None, 2)


def test_keep_first_of_a_hot_text_collapses_before_the_shuffle(spark):
    rows = spark.range(20000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text"), F.col("id").alias("pos"))
    kept = keep_first(rows, ["text"], "pos")
    assert kept.where("text = 'hot'").first()["pos"] == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2 and "SortAggregate" not in plan


def test_canonical_id_is_sha1(spark):
    rows = spark.createDataFrame([("101",)], "text_id STRING")
    got = rows.select(ids.canonical_id("llm", F.col("text_id"))).first()[0]
    assert got == hashlib.sha1(b"llm::101").hexdigest()


def test_dense_ids_cover_zero_to_n(spark):
    rows = spark.range(0, 5000, 3, 7).select((F.col("id") * 31 % 5003).alias("pos"))
    got = dense_ids(rows.withColumn("c", chunk_of(F.col("pos"), 6)), ["pos"], ["c"], "i").collect()
    ordered = sorted(got, key=lambda x: x["pos"])
    assert [x["i"] for x in ordered] == list(range(len(ordered)))


def test_dense_ids_of_sparse_positions_with_a_hot_range(spark):
    """A third of the rows sit in one run of neighbours, the rest far apart."""
    far = spark.range(200).select((F.col("id") * (1 << 40) + 5).alias("pos"))
    near = spark.range(100).select(((F.lit(7) * (1 << 40)) + 6 + F.col("id") * 3000).alias("pos"))
    rows = far.unionByName(near).withColumn("c", chunk_of(F.col("pos")))
    got = sorted(dense_ids(rows, ["pos"], ["c"], "i").collect(), key=lambda x: x["pos"])
    assert [x["i"] for x in got] == list(range(300))


def test_positions_follow_a_mixed_order(spark):
    rng = random.Random(1)
    data = [(f"w{i}", rng.randrange(5)) for i in range(500)]
    rows = spark.createDataFrame(data, "word STRING, n INT").repartition(6)
    got = {x["word"]: x["i"] for x in positions(rows, [F.desc("n"), F.asc("word")], "i").collect()}
    want = {w: i for i, (w, _) in enumerate(sorted(data, key=lambda x: (-x[1], x[0])))}
    assert got == want


def test_batches_are_full(spark):
    rows = spark.range(1000).select((F.col("id") * 7).alias("key"))
    sizes = Counter(x["batch_id"] for x in batches(rows, "key", 314).collect())
    assert sizes == {0: 314, 1: 314, 2: 314, 3: 58}


def test_seeded_order_ignores_the_layout(spark):
    rows = spark.range(300).withColumnRenamed("id", "key")
    one = {x["key"]: x["p"] for x in seeded_order(rows, "key", "p").collect()}
    two = {x["key"]: x["p"] for x in seeded_order(rows.repartition(9), "key", "p").collect()}
    assert one == two and sorted(one.values()) == list(range(300))
    assert one != {x["key"]: x["p"] for x in seeded_order(rows, "key", "p", seed=7).collect()}


@pytest.mark.parametrize("n", [1, 7, 10, 101])
def test_split_exact_sizes(spark, n):
    rows = spark.range(n).withColumnRenamed("id", "key")
    sizes = Counter(x["split"] for x in split.split_exact(rows, "key").collect())
    held = math.ceil(0.3 * n)
    test = math.ceil(0.5 * held)
    assert (sizes["train"], sizes["val"], sizes["test"]) == (n - held, held - test, test)


def test_split_by_hash_shares(spark):
    rows = spark.range(20000).withColumnRenamed("id", "key")
    sizes = Counter(x["split"] for x in split.split_by_hash(rows, "key").collect())
    assert abs(sizes["train"] - 14000) < 300 and abs(sizes["val"] - 3000) < 250


def skewed_rows(spark):
    """A third of the rows share one known key, a third one unknown key."""
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, "nowhere").otherwise(
        F.concat(F.lit("k"), F.col("id") % 4000)
    )
    return spark.range(9000).select("id", F.when(F.col("id") % 50 != 0, key).alias("word"))


def test_lookup_ways_agree(spark):
    rows = skewed_rows(spark)
    table = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("word"), F.col("id").alias("value"))
    table = table.unionByName(spark.createDataFrame([("hot", -5)], "word STRING, value BIGINT"))
    small = lookup(rows, table, "word", spread_by=["id"])
    large = lookup(rows, table, "word", spread_by=["id"], broadcast_bytes=0)
    assert sorted(map(tuple, small.collect()), key=repr) == sorted(map(tuple, large.collect()), key=repr)
    assert large.count() == 9000


def test_encode_keeps_order_and_length(spark):
    vocab = spark.createDataFrame([("the", 9, 0), ("cat", 2, 1)], "word STRING, n BIGINT, idx BIGINT")
    rows = spark.createDataFrame([(1, ["the", "dog", "cat", "the"]), (2, []), (3, ["dog"])], "text_id BIGINT, tokens ARRAY<STRING>")
    want = {1: [1, 0, 2, 1], 2: [], 3: [0]}
    for limit in (1 << 20, 0):
        got = {x["text_id"]: x["ids"] for x in e.encode(rows, vocab, ["text_id"], broadcast_bytes=limit).collect()}
        assert got == want


def test_vocab_order(spark):
    rows = spark.createDataFrame([(["b", "a", "c", "a", "b"],), (["d", "a"],)], "tokens ARRAY<STRING>")
    got = sorted((x["idx"], x["word"], x["n"]) for x in e.build_vocab(rows).collect())
    assert got == [(0, "a", 3), (1, "b", 2), (2, "c", 1), (3, "d", 1)]
    assert e.vocab_size(e.build_vocab(rows, min_count=2)).first()[0] == 3


def test_padding(spark):
    rng = random.Random(3)
    data = [(i, [rng.randrange(1, 9) for _ in range(rng.randrange(200))]) for i in range(40)]
    rows = spark.createDataFrame(data, "text_id BIGINT, ids ARRAY<INT>")
    originals = dict(data)
    padded = e.pad_batches(rows, "text_id", 16).collect()
    for b in {x["batch_id"] for x in padded}:
        group = [x for x in padded if x["batch_id"] == b]
        assert {len(x["ids"]) for x in group} == {max(len(originals[x["text_id"]]) for x in group)}
    for x in padded:
        own = originals[x["text_id"]]
        assert x["ids"][: len(own)] == own and not any(x["ids"][len(own):])
    for x in e.fixed_samples(rows).collect():
        n = min(len(originals[x["text_id"]]), 128)
        assert len(x["input_ids"]) == len(x["attention_mask"]) == 128 and sum(x["attention_mask"]) == n
        assert x["input_ids"][:n] == originals[x["text_id"]][:n]


def test_mean_embedding(spark):
    vectors = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 6.0])], "idx INT, vec ARRAY<FLOAT>")
    rows = spark.createDataFrame([(1, [1, 2, 0, 0]), (2, []), (3, [0])], "text_id BIGINT, ids ARRAY<INT>")
    for options in ({}, {"broadcast_bytes": 0}):
        got = {x["text_id"]: x["mean"] for x in e.mean_embedding(rows, vectors, ["text_id"], 2, **options).collect()}
        assert got == {1: [1.0, 2.0], 2: [0.0, 0.0], 3: [0.0, 0.0]}


def test_polarity(spark):
    rows = spark.createDataFrame([(1, ["a"], 1), (2, ["b"], 0)], "text_id BIGINT, tokens ARRAY<STRING>, label INT")
    assert {x["text_id"]: x["human_wrote"] for x in e.token_targets(rows).collect()} == {1: 0, 2: 1}


def test_curation_rules(spark):
    rows = spark.createDataFrame(
        [(0, "a1", "  hi \n", None), (1, "a2", "  ", 0), (2, "a3", None, 0), (3, None, "hi", 1), (4, None, "new", 1)],
        "pos BIGINT, text_id STRING, text STRING, label INT",
    )
    got = {x["text"]: x for x in curate.curate_generated(rows).collect()}
    assert set(got) == {"hi", "new"}
    assert got["hi"]["label"] == 1 and got["hi"]["text_id"] == hashlib.sha1(b"llm::a1").hexdigest()
    assert got["new"]["text_id"] == hashlib.sha1(b"llm::4").hexdigest()
    assert got["hi"]["source"] == "llm" and got["hi"]["model"] is None
    assert {x["label"] for x in curate.curate_posts(rows.drop("label")).collect()} == {0}


def test_main_table_keeps_source_order_and_copies(spark):
    def source(*texts):
        return curate.placed(spark.createDataFrame([(i, x, 0) for i, x in enumerate(texts)], "pos BIGINT, text STRING, label INT"))

    got = curate.merge_main([source("b", "a"), source("a"), source("c", "b")]).orderBy("text_id").collect()
    assert [(x["text_id"], x["text"]) for x in got] == [(0, "b"), (1, "a"), (2, "a"), (3, "c"), (4, "b")]


def test_cleaning_follows_raw_duplicates_and_earliest_label(spark):
    rows = spark.createDataFrame(
        [("Hi", 0, 0), ("Hi", 1, 1), ("hi", 1, 2), ("hz§", 1, 3), ("@x", 0, 4), (None, 1, 5), ("odd", 7, 6), ("odd", 1, 7)],
        "text STRING, label INT, text_id BIGINT",
    )
    got = sorted((x["text_id"], x["label"], x["text"]) for x in clean.clean_corpus(rows).collect())
    assert got == [(0, 0, "hi"), (2, 1, "hi"), (3, 1, "h"), (4, 0, "")]


def test_cleaning_with_nothing_to_remove(spark):
    rows = spark.createDataFrame([("ab", 0, 0), ("a", 1, 1)], "text STRING, label INT, text_id BIGINT")
    assert sorted(x["text"] for x in clean.clean_corpus(rows).collect()) == ["a", "ab"]


def test_argmax_takes_the_first_of_equals(spark):
    rows = spark.createDataFrame([([2.0, 2.0],), ([1.0, 3.0],)], "z ARRAY<DOUBLE>")
    got = rows.select(sc.argmax(F.col("z")), F.array_max(sc.softmax(F.col("z")))).collect()
    assert [x[0] for x in got] == [0, 1] and got[0][1] == 0.5
    both = s.decide(spark.createDataFrame([(2.0, 2.0)], "z0 DOUBLE, z1 DOUBLE")).first()
    assert (both["prediction"], both["label"], both["confidence"]) == (0, "AI-Generated", 0.5)


def test_cross_entropy(spark):
    rows = spark.createDataFrame([([1000.0, 0.0], 1), ([0.0, 0.0], 0)], "z ARRAY<DOUBLE>, t INT")
    got = [x[0] for x in rows.select(sc.cross_entropy(F.col("z"), F.col("t"))).collect()]
    assert got[0] == pytest.approx(1000.0) and got[1] == pytest.approx(math.log(2))


def test_accuracy_of_nothing_is_null(spark):
    rows = spark.createDataFrame([], "prediction INT, target INT")
    assert tuple(s.accuracy(rows).first()) == (0, 0, None)


def test_best_checkpoints_want_strictly_more(spark):
    data = [("r", i, a) for i, a in enumerate([0.0, 0.5, 0.5, 0.4, 0.7])]
    got = history.best_checkpoints(spark.createDataFrame(data, "run STRING, epoch INT, val_acc DOUBLE")).collect()
    assert [(x["epoch"], x["is_best"]) for x in sorted(got, key=lambda x: x["epoch"])] == [(1, False), (4, True)]


def test_learning_rate_steps(spark):
    rows = history.with_learning_rate(spark.range(7).withColumnRenamed("id", "epoch")).orderBy("epoch")
    assert [x["lr"] for x in rows.collect()] == [1e-4] * 3 + [5e-5] * 3 + [2.5e-5]


@pytest.mark.parametrize("name, want", [
    ("lstm_92.8_2025-10-12_18-23-37.pt", ("LSTM", 92.8, "2025-10-12 18:23:37", True, True)),
    ("rnn_84_2025-10-12_20-12-15.pt", ("RNN", 84.0, "2025-10-12 20:12:15", True, True)),
    ("bert_90.1_2025-13-40_18-23-37.pt", ("BERT", 90.1, "2025-13-40 18-23-37", True, False)),
    ("model.pt", ("UNKNOWN", 0.0, "Unknown", False, False)),
    ("lstm_92.8_2025-10-12_18-23-37.pth", ("UNKNOWN", 0.0, "Unknown", False, False)),
])
def test_model_names(spark, name, want):
    files = spark.createDataFrame([(f"dir/{name}", 3 * 1024 * 1024)], "path STRING, size BIGINT")
    x = registry.catalogue(files).first()
    assert (x["model_type"], x["accuracy"], x["formatted_time"], x["parsed"], x["timestamp"] is not None) == want
    assert x["name"] == name and x["size_mb"] == 3.0


def test_sort_choice_is_checked(spark):
    with pytest.raises(ValueError):
        registry.order_of("colour")


def test_model_types(spark):
    rows = spark.createDataFrame(
        [("BERT", True, None), ("GRU", True, None), ("UNKNOWN", False, None), ("BERT", True, "Lstm"), ("BERT", True, "x")],
        "model_type STRING, parsed BOOLEAN, given STRING",
    )
    got = [x[0] for x in rows.select(naming.resolve_type(F.col("model_type"), F.col("parsed"), F.col("given"))).collect()]
    assert got == ["bert", "rnn", "rnn", "lstm", "rnn"]


def test_number_format_uses_the_exact_value(spark):
    rows = spark.createDataFrame([(58.01125, 0.5)], "a DOUBLE, b DOUBLE")
    assert tuple(rows.select(sc.fixed(F.col("a"), 4), sc.percent(F.col("b"))).first()) == (f"{58.01125:.4f}", "50.0%")


@pytest.mark.parametrize("body, single, batch", [
    ('{"text":" x "}', None, s.NO_TEXTS), ('{"text":"  "}', s.EMPTY_TEXT, s.NO_TEXTS), ("{}", s.NO_TEXT, s.NO_TEXTS),
    ('{"text":5}', s.FAILED, s.NO_TEXTS), ("oops", s.FAILED, s.BATCH_FAILED), ('{"texts":[]}', s.NO_TEXT, s.BAD_TEXTS),
    ('{"texts":"[1]"}', s.NO_TEXT, s.BAD_TEXTS), ('{"texts":null}', s.NO_TEXT, s.BAD_TEXTS), ('{"texts":["a"]}', s.NO_TEXT, None),
    ("[]", s.NO_TEXT, s.NO_TEXTS), (None, s.FAILED, s.BATCH_FAILED),
])
def test_request_errors(spark, body, single, batch):
    rows = spark.createDataFrame([(body,)], "body STRING")
    assert tuple(rows.select(s.single_error(F.col("body")), s.batch_error(F.col("body"))).first()) == (single, batch)


def test_batches_refuse_only_the_blank_row(spark):
    rows = spark.createDataFrame([(1, '{"texts":["a","  ","b"]}'), (2, "bad")], "id INT, body STRING")
    got = s.explode_batch(rows, "body", ["id"]).orderBy("index").collect()
    assert [(x["index"], x["text"], x["error"]) for x in got] == [(0, "a", None), (1, "  ", s.EMPTY_TEXT), (2, "b", None)]


def test_blocks_keep_line_spaces(spark):
    rows = spark.createDataFrame([(1, "\n one \n\n \t\ntwo  \n")], "id INT, block STRING")
    got = s.split_block(rows, "block", ["id"]).orderBy("index").collect()
    assert [x["text"] for x in got] == ["one ", "two"]


def test_sinks(spark):
    rows = spark.createDataFrame([('say "hi"', 1), (" two\nlines ", 0), ("", 1)], "text STRING, label INT").coalesce(1)
    with pytest.raises(ValueError):
        k.write_cleaned(rows, fresh_dir(spark, "t"), "orc")
    path, n = k.write_curated(rows, fresh_dir(spark, "t"), "posts", "20240101T000000Z")
    assert n == 3 and path.endswith("/curated/posts/run=20240101T000000Z")
    csv = k.write_cleaned(rows, fresh_dir(spark, "t"), "csv")
    back = r.read_labelled_csv(spark, csv).orderBy("src_row").collect()
    assert [x["text"] for x in back][:2] == ['say "hi"', " two\nlines "]


def test_human_csv_is_latin1_and_keeps_every_row(spark):
    rows = spark.createDataFrame([("été, \"quoted\"",), ("second",)], "text STRING").coalesce(1)
    six = rows.select(*[F.lit("0").alias(c) for c in ("target", "id", "date", "flag", "user")], "text")
    path = k.write_human_csv(six, fresh_dir(spark, "t"))
    got = r.read_human_csv(spark, path).orderBy("src_row").collect()
    assert [(x["text"], x["label"]) for x in got] == [("été, \"quoted\"", 0), ("second", 0)]


def test_missing_tokens_option(spark):
    rows = spark.createDataFrame([("NA", 1), ("ok", 0)], "text STRING, label INT")
    path = k.append_csv(rows, fresh_dir(spark, "t"))
    assert r.read_labelled_csv(spark, path).where("text IS NULL").count() == 0
    assert r.read_labelled_csv(spark, path, na_tokens=("NA",)).where("text IS NULL").count() == 1


def test_ragged_records(spark):
    path = fresh_dir(spark, "t")
    lines = ['{"text_id":"1","text":"a","label":1,"model":"m"}', '{"text":"b"}']
    spark.createDataFrame([(x,) for x in lines], "value STRING").write.text(path)
    got = {x["text"]: x for x in r.read_records(spark, path, schemas.RAW_GENERATED).collect()}
    assert got["a"]["model"] == "m" and got["b"]["label"] is None and got["b"]["text_id"] is None


def test_model_scan_reads_model_files_only(spark, tmp_path):
    for name in ("a.pt", "b.pth", "c.pkl", "d.model", "e.txt"):
        (tmp_path / name).write_bytes(b"12345")
    got = registry.catalogue(r.scan_model_files(spark, str(tmp_path))).collect()
    assert sorted(x["name"] for x in got) == ["a.pt", "b.pth", "c.pkl", "d.model"] and {x["size"] for x in got} == {5}


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_root(spark) == named.rstrip("/")

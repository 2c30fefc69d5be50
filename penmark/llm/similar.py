"""Near copies for the pipeline: documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

1. *Shingles*: words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case, five in a row (fewer words: all of them), hashed to 64 bits.
2. *Classes*: texts with one set of shingles (128-bit digest) are one class from here on, so a group of copies is one row. Null, empty and
   blank texts have no shingles and are one class.
3. *Range join*: the 64-bit SimHash of the shingles is put on operator 10's grid of segment popcounts (:func:`simhash_dedup.links`). Classes that
   meet there and differ in at most ``BITS`` bits are the first candidates; those of one fingerprint meet its smallest class.
4. *The rest*: pairs of exactly 0.8 are about 10 bits apart, and few such lie within two steps of the grid; no wider grid of popcounts
   separates them from unrelated texts. So what the range join leaves apart meets in ``BANDS`` bands of ``ROWS`` min-hashes. Two sets agree in a
   band with a chance of ``J ** ROWS``; a pair of exactly 0.8 is missed in all bands with a chance of 5e-8, a more similar one more rarely.
5. *Exact check*: both texts are read and the similarity is counted. Only links that pass are kept.
6. *Few pairs*: in each of ``ROUNDS`` rounds every member of a band is compared with one centre, the member that meets most others in all its
   bands, unless both are in one component already; the centre has then met all of its band and leaves it. Pairs stay linear in members,
   and the centre of a group of near copies joins it. Members of a band that are in different components after the last round meet only
   where they share one of their rarest shingles (similar sets must: few may be missing), at places and sizes that leave
   the similarity possible, and are compared if their rarest shingles agree enough. What is left out joins rows that are joined
   already or cannot be similar; nothing is met pair by pair because it shares a band.

A null ``doc_id`` takes part and never stands for a component if there is another id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from penmark.llm import simhash_dedup
from penmark.llm.common import arrow, discard, keyed, mix, slices, store, utf8, words_of
from penmark.llm.components import components

WORDS, BANDS, ROWS, SEED = 5, 32, 4, 42
LEAST = (4, 5)  # the similarity, as a fraction
ROUNDS = 2
BITS = 16  # SimHashes of similar texts are rarely further apart
_RNG = np.random.default_rng(SEED)
_ORDERS = _RNG.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RNG.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """The distinct shingles of every text, sorted."""
    symbols, counts = words_of([t.lower() for t in texts])
    n = max(0, len(symbols) - words + 1)
    runs = np.zeros(n, np.uint64)
    for j in range(words):
        runs += symbols[j : j + n] * _PLACES[j]
    runs, out, at = mix(runs), [], 0
    for count in counts.tolist():
        if count >= words:
            out.append(np.unique(runs[at : at + count - words + 1]))
        elif count:
            short = (symbols[at : at + count] * _PLACES[:count]).sum(dtype=np.uint64)
            out.append(mix(np.array([short + np.uint64(count)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += count
    return out


def bands(found: np.ndarray) -> np.ndarray:
    """One number for each band of a set of shingles."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), 512):
        np.minimum(least, np.multiply.outer(_ORDERS, found[at : at + 512]).min(axis=1), out=least)
    rows = least.reshape(BANDS, ROWS)
    return mix((mix(rows) * _PLACES[:ROWS]).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """``__k1, __k2, cls, n, fp, bands`` of every row: key, digest, size and SimHash of the set of shingles, and its bands (none if it is empty)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            sets = shingle_sets(utf8(batch.column("text")))
            columns = [batch.column("__k1"), batch.column("__k2"),
                       pa.array([hashlib.blake2b(s.astype("<u8").tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                       pa.array([len(s) for s in sets], pa.int64()),
                       pa.array([simhash_dedup.majority(s) for s in sets], pa.int64()),
                       pa.array([bands(s) if len(s) else np.zeros(0, np.int64) for s in sets], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["__k1", "__k2", "cls", "n", "fp", "bands"])

    return arrow(keyed(docs).select("__k1", "__k2", "text"), run, "__k1 long, __k2 long, cls binary, n long, fp long, bands array<long>")


def checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of classes that are similar enough. ``texts`` has ``cls, text`` of each class."""
    up, down = LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            left, right = shingle_sets(utf8(batch.column("text"))), shingle_sets(utf8(batch.column("other")))
            both = [len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(left, right)]
            near = pa.array([down * n >= up * (len(x) + len(y) - n) for n, x, y in zip(both, left, right)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(near)

    used = pairs.select(F.col("a").alias("cls")).union(pairs.select(F.col("b").alias("cls"))).distinct()
    texts = texts.join(used, "cls", "left_semi")
    first = pairs.join(texts.select(F.col("cls").alias("a"), "text"), "a")
    rows = first.join(texts.select(F.col("cls").alias("b"), F.col("text").alias("other")), "b").select("a", "b", "text", "other")
    return arrow(rows, run, "a binary, b binary")


def rare_shingles(texts: DataFrame) -> DataFrame:
    """``cls, n, shingle, place, least``: of each class the shingles among its ``least`` rarest that another class has too.

    Rarity is the number of classes of ``texts`` with the shingle, ties by the shingle itself, one order for all. ``least`` is one more than the
    shingles that may be missing from any similar set, so the rarest shingle of two similar sets is among them in both. The
    smaller set may lack fewer (:func:`_fewest`).
    """
    up, down = LEAST

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            sets = [s.view(np.int64) for s in shingle_sets(utf8(batch.column("text")))]
            yield pa.RecordBatch.from_arrays([batch.column("cls"), pa.array(sets, pa.list_(pa.int64()))], names=["cls", "shingles"])

    rows = arrow(texts.select("cls", "text"), run, "cls binary, shingles array<long>")
    rows = rows.select("cls", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    rows = store(rows, "similar-shingles")
    times = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("times"))
    least = F.col("n") - F.ceil(F.col("n") * up / down) + 1
    place = F.row_number().over(Window.partitionBy("cls").orderBy("times", "shingle"))
    placed = rows.join(times, "shingle").withColumns({"least": least, "place": place}).where("place <= least AND times > 1")
    found = store(placed.select("cls", "n", "shingle", "place", "least"), "similar-rare")
    discard(rows)
    return found


def _sized(x: str, y: str):
    """Sets whose sizes alone rule the similarity out are not compared."""
    up, down = LEAST
    return F.least(x, y) * down >= F.greatest(x, y) * up


def _fewest(n: str):
    """One more than the shingles of a set of ``n`` that a similar set of the same size or larger may lack."""
    up, down = LEAST
    return F.col(n) - F.ceil(F.col(n) * 2 * up / (up + down)) + 1


def _step(n: str):
    """Sizes in steps of about a fiftieth; similar sets are at most a dozen steps apart."""
    return F.floor(F.log(F.greatest(n, F.lit(1))) * 50).cast("int")


def _rooted(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``rows`` with the ``root`` of each class, itself where it is linked to none or is the smallest."""
    joined = components(found).select(F.col("a").alias("cls"), F.col("b").alias("root"))
    return rows.drop("root").join(joined, "cls", "left").withColumn("root", F.coalesce("root", "cls"))


def close_prints(classes: DataFrame) -> DataFrame:
    """``a, b``: pairs of classes that operator 10's range join finds, by the smallest class of each fingerprint, and each other class
    of a fingerprint with that one. Sizes alone may not rule the similarity out."""
    held = classes.where("n > 0").select("fp", "cls", "n")
    heads = store(held.groupBy("fp").agg(F.min(F.struct("cls", "n")).alias("head")), "similar-prints")
    # few bytes, much work: dealt out by number, as by size they would be one task
    near = simhash_dedup.links(heads.select("fp").repartition(2 * heads.sparkSession.sparkContext.defaultParallelism, "fp"), bits=BITS)
    for side in ("a", "b"):
        near = near.join(heads.select(F.col("fp").alias(side), F.col("head").alias(f"head_{side}")), side)
    same = held.join(heads, "fp").where("cls <> head.cls").select(F.struct("cls", "n").alias("head_a"), F.col("head").alias("head_b"))
    pairs = near.select("head_a", "head_b").unionByName(same).where(_sized("head_a.n", "head_b.n"))
    found = store(pairs.select(F.greatest("head_a.cls", "head_b.cls").alias("a"), F.least("head_a.cls", "head_b.cls").alias("b")), "similar-close")
    discard(heads)
    return found


def links(classes: DataFrame, texts_of: Callable[[DataFrame], DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """``a, b``: pairs of similar classes, enough to join what is connected. ``classes`` has ``cls, n, fp, bands``; ``texts_of``
    gives ``cls, text`` for the classes of a table."""
    up, down = LEAST
    rows = classes.select("cls", "n", F.explode("bands").alias("band"))
    met = rows.groupBy("band").agg(F.min("cls").alias("x"), F.max("cls").alias("y"), F.count(F.lit(1)).alias("size")).where("x < y")
    members = store(rows.join(met.select("band", "size").hint("merge"), "band"), "similar-members")
    weight = store(members.groupBy("cls").agg(F.sum("size").alias("weight")), "similar-weight")
    close = close_prints(classes)
    wanted = reduce(DataFrame.union, [weight.select("cls"), close.select("a"), close.select("b")]).distinct()
    texts = store(texts_of(wanted), "similar-texts")
    found, tested = [], []

    def untested(pairs: DataFrame) -> DataFrame:
        pairs = pairs.distinct()
        for before in tested:
            pairs = pairs.join(before, ["a", "b"], "left_anti")
        tested.append(store(pairs, "similar-pairs"))
        return tested[-1]

    found.append(store(checked(untested(close), texts), "similar-near"))
    live = store(_rooted(members.join(weight, "cls").select("cls", "n", "band", "weight"), found[0]), "similar-live")
    discard(members, close)
    for _ in range(rounds):
        order = F.struct("weight", F.xxhash64("cls", "band"))
        centres = live.groupBy("band").agg(
            F.max_by(F.struct("cls", "n", "root"), order).alias("c"), F.min("root").alias("x"), F.max("root").alias("y")
        ).where("x < y").select("band", "c")
        star = store(live.join(centres.hint("merge"), "band").where("cls <> c.cls"), "similar-star")
        discard(live)
        near = star.where("root <> c.root").where(_sized("n", "c.n"))
        pairs = untested(near.select(F.greatest("cls", "c.cls").alias("a"), F.least("cls", "c.cls").alias("b")))
        found.append(store(checked(pairs, texts), "similar-near"))
        live = store(_rooted(star.drop("c"), reduce(DataFrame.unionByName, found)), "similar-live")
        discard(star)
    mixed = live.groupBy("band").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x < y").select("band")
    rest = store(live.join(mixed, "band", "left_semi"), "similar-open")
    rare = rare_shingles(texts.join(rest.select("cls").distinct(), "cls", "left_semi"))
    ours = rare.join(rest.select("cls", "root").distinct(), "cls")
    smaller = ours.where(F.col("place") <= _fewest("n")).select("shingle", _step("n").alias("step"), F.col("cls").alias("a"), "n", "root", "place")
    larger = ours.select("shingle", F.col("cls").alias("b"), F.col("n").alias("m"), F.col("root").alias("at"), F.col("place").alias("q"))
    # nothing is shared before the rarest shingle of both, so its place bounds the other's size
    low, high = F.ceil(F.col("m") * up / down), F.floor((F.col("m") - F.col("q") + 1) * (up + down) / up) - F.col("m")
    larger = larger.withColumns({"low": low, "high": F.least(high, "m")}).where("low <= high")
    larger = larger.withColumn("step", F.explode(F.sequence(_step("low"), _step("high")))).drop("low", "high")
    shared = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("q")) + 1
    possible = (shared * (up + down) >= (F.col("n") + F.col("m")) * up) & _sized("n", "m") & F.expr("(n < m OR n = m AND a < b) AND root <> at")
    both = smaller.join(larger, ["shingle", "step"]).where(possible).select("a", "b", "n", "m").distinct()
    sets = store(rare.groupBy("cls").agg(F.collect_list("shingle").alias("held"), F.any_value("least").alias("least")), "similar-held")
    for side in ("a", "b"):
        both = both.join(sets.select(F.col("cls").alias(side), F.col("held").alias(f"held_{side}"), F.col("least").alias(f"least_{side}")), side)
    # a shingle of both is among the rarest of both, or beyond the rarest of the set whose rarest end first
    beyond = F.greatest(F.col("n") - F.col("least_a"), F.col("m") - F.col("least_b"))
    meet = F.size(F.array_intersect("held_a", "held_b"))
    both = both.where((meet + beyond) * (up + down) >= (F.col("n") + F.col("m")) * up)
    both = both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found.append(store(checked(untested(both), texts), "similar-near"))
    discard(weight, texts, live, rest, rare, sets, *tested)
    return reduce(DataFrame.unionByName, found)


def keep_one(docs: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """One row of every component of similar documents (the smallest ``doc_id``; among rows equal in id and text any), with all columns."""
    rows = store(signatures(docs), "similar-signatures")
    first = F.min(F.struct("__k1", "__k2")).alias("first")
    classes = store(rows.groupBy("cls").agg(first, *[F.any_value(c).alias(c) for c in ("n", "fp", "bands")]), "similar-classes")
    discard(rows)
    heads = classes.select("cls", F.col("first.__k1").alias("__k1"), F.col("first.__k2").alias("__k2"))

    def texts_of(wanted: DataFrame) -> DataFrame:
        found = keyed(docs).select("__k1", "__k2", "text").join(heads.join(wanted, "cls", "left_semi"), ["__k1", "__k2"])
        return found.groupBy("cls").agg(F.min("text").alias("text"))

    root = _rooted(classes.select("cls", "first"), links(classes, texts_of, rounds))
    kept = store(root.groupBy("root").agg(F.min("first").alias("first")).select("first.__k1", "first.__k2"), "similar-kept")
    discard(classes)
    return keyed(docs).join(kept, ["__k1", "__k2"], "left_semi").dropDuplicates(["__k1", "__k2"]).select(*docs.columns)

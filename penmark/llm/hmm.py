"""Operator 7, a hidden Markov language model: Baum-Welch over partitions, scores by the scaled forward recursion.

Texts are A-Z in lower case; tokens are the words ``[^\\x20\\x09-\\x0D]+`` and one end. Training texts are those whose
``crc32(doc_id as text) mod 7`` is not 2.

* *Counts*: all tokens of all training texts are counted exactly (words by 64-bit fingerprints).
* *Symbols*: the ``HOT`` most frequent words are symbols of the model. Any other word is the symbol of its class (its last two bytes), times
  its share of the class, ``(c + 1) / (N + V + 1)`` with the class's ``N`` tokens and ``V`` words. So every word, known or not, has a
  probability that follows from its own count.
* *Training*: texts are cut into runs of ``RUN`` symbols. In each of ``ROUNDS`` rounds every partition runs the scaled forward and backward
  recursions and sums expected starts, transitions and emissions; the sums are added block by block in Spark and normalised.
* *Score*: log10 of the forward likelihood of the whole symbol sequence, plus the shares. Long texts are cut into chunks; each chunk gives the
  matrix of the recursion, so the chunks of many texts run side by side and the result is exact.

Counts of the ``KNOWN`` most frequent words are looked up in tasks (a table of fixed size); all other words are looked up by a join. Symbols
and emissions have fixed size too. Null text is empty (one token, the end). Null ids are taken as the text ``""``. Rows equal in id and
text count and are scored once each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from penmark.llm.common import arrow, keyed, slices, store, utf8, words_of

HOT, KNOWN, CLASSES = 1 << 15, 1 << 18, 512
STATES, ROUNDS, RUN, CHUNK_LEN, SEED = 6, 4, 128, 512, 9
FOLDS, HELD_OUT = 7, 2
END = 0  # fingerprint of the end token
_SYMBOLS = HOT + CLASSES
_BLOCK = 4096  # symbols whose expected counts travel as one row
RUNS = 2048  # run side by side


def held_out() -> Column:
    digits = F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")
    return F.crc32(digits) % FOLDS == HELD_OUT


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Fingerprint and class of every token, texts one after another with their end, and tokens per text."""
    texts = [t.lower() for t in texts]
    words, counts = words_of(texts)
    pairs = np.array([w[-2:].rjust(2, b"\0") for t in texts for w in t.split()], "S2") if len(words) else np.zeros(0, "S2")
    two = np.frombuffer(pairs.tobytes(), np.uint8).reshape(-1, 2).astype(np.int64)
    kinds = (two[:, 0] * 31 + two[:, 1] * 7) % CLASSES
    at = np.cumsum(counts)
    return np.insert(words, at, np.uint64(END)), np.insert(kinds, at, 0), counts + 1


def word_counts(docs: DataFrame) -> DataFrame:
    """``w, kind, n``: exact counts of the tokens of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            words, kinds = (np.concatenate(x) for x in zip(*held))
            w, first, n = np.unique(words, return_index=True, return_counts=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(w.view(np.int64)), pa.array(kinds[first].astype(np.int32)), pa.array(n)], names=["w", "kind", "n"])

        for batch in (s for b in batches for s in slices(b)):
            words, kinds, _ = _tokens(utf8(batch.column("text")))
            held.append((words, kinds))
            size += len(words)
            if size > 4_000_000:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    rows = arrow(docs.select("text"), run, "w long, kind int, n long")
    return rows.groupBy("w").agg(F.min("kind").alias("kind"), F.sum("n").alias("n"))


PARTS = 1 << 20  # a level of frequency is taken in whole or so many parts


@dataclass
class Vocabulary:
    known: np.ndarray  # sorted fingerprints (unsigned) of the most frequent words
    count: np.ndarray
    symbol: np.ndarray  # of each: below HOT if it is a symbol of its own, else -1
    total: int
    distinct: int
    class_log: np.ndarray  # log10(N + V + 1) of every class

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (-1: not in the table) and own symbol (-1: none) of each word."""
        at = np.minimum(np.searchsorted(self.known, words), max(0, len(self.known) - 1))
        if not len(self.known):
            return np.full(len(words), -1), np.full(len(words), -1)
        hit = self.known[at] == words
        return np.where(hit, self.count[at], -1), np.where(hit, self.symbol[at], -1)


def vocabulary(counts: DataFrame, hot: int = HOT, known: int = KNOWN) -> Vocabulary:
    """The bounded tables of the model, from the stored counts."""
    total, distinct = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    # Down to which level of frequency the table has room, so that no task sends more than its share; of the level that is too big,
    # the part of its words (by their fingerprint) that there is room for.
    level, room, cut, part = F.floor(F.log2("n") * 64), known, 1 << 30, 0
    for row in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        cut = row["level"]
        part = min(PARTS, PARTS * room // row["count"])
        room -= row["count"]
        if room <= 0:
            break
    fits = (level > cut) | ((level == cut) & (F.pmod("w", F.lit(PARTS)) < part))
    top = counts.where(fits).select("w", "kind", "n").toArrow().to_pandas()
    top = top.sort_values(["n", "w"], ascending=[False, True], ignore_index=True)
    w = top["w"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(w)
    classes = np.zeros((CLASSES, 2))
    for row in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).collect():
        classes[row["kind"]] = row["n"], row["v"]
    np.subtract.at(classes, top["kind"].to_numpy()[:hot], np.stack([top["n"].to_numpy()[:hot], np.ones(len(top[:hot]))], axis=1))
    symbol = np.where(np.arange(len(w)) < hot, np.arange(len(w)), -1)
    return Vocabulary(w[order], top["n"].to_numpy(np.int64)[order], symbol[order], int(total or 0), int(distinct), np.log10(classes.sum(axis=1) + 1))


def _encode(vocabulary: Vocabulary):
    """Per text: symbols, and the sums that follow from them; the words whose count is not at hand, with their repeats."""
    v = vocabulary
    floor = math.log10(v.total + v.distinct + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (s for b in batches for s in slices(b)):
            words, kinds, lengths = _tokens(utf8(batch.column("text")))
            count, symbol = v.look_up(words)
            own = symbol >= 0
            ends = np.cumsum(lengths)
            row = np.repeat(np.arange(len(lengths)), lengths)

            def per_row(values: np.ndarray) -> np.ndarray:
                return np.bincount(row, values, minlength=len(lengths))

            known = count >= 0
            logs = np.log10(np.maximum(count, 0) + 1.0)
            share = np.where(own, 0, np.where(known, logs, 0) - v.class_log[kinds])
            symbols = np.where(own, symbol, HOT + kinds).astype(np.int32)
            far = ~known
            pairs = np.stack([row[far].astype(np.uint64), words[far]], axis=1)
            order = np.lexsort((pairs[:, 1], pairs[:, 0]))
            pairs = pairs[order]
            heads = np.flatnonzero(np.concatenate(([True], (pairs[1:] != pairs[:-1]).any(axis=1)))) if len(pairs) else np.zeros(0, int)
            repeats = np.diff(np.append(heads, len(pairs)))
            far_at = np.concatenate(([0], np.cumsum(np.bincount(pairs[heads, 0].astype(np.int64), minlength=len(lengths)))))
            rest = pa.StructArray.from_arrays([pa.array(pairs[heads, 1].view(np.int64)), pa.array(repeats.astype(np.int32))], names=["w", "n"])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("__k1", "__k2", "doc_id", "held_out")), pa.array(lengths), pa.array(per_row(known).astype(np.int64)),
                 pa.array(per_row(np.where(known, logs, 0)) - floor * lengths), pa.array(per_row(share)),
                 pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends)).astype(np.int32)), pa.array(symbols)),
                 pa.ListArray.from_arrays(pa.array(far_at.astype(np.int32)), rest)],
                names=["__k1", "__k2", "doc_id", "held_out", "n_tokens", "n_known", "base", "share", "symbols", "rest"],
            )

    return run


_CODED = ("__k1 long, __k2 long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, share double, "
          "symbols array<int>, rest array<struct<w:long,n:int>>")


@dataclass
class Hmm:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # symbol x state
    usual: np.ndarray  # how often each state holds: the start of a run inside a text


def first_guess(vocabulary: Vocabulary, states: int = STATES, symbols: int = _SYMBOLS) -> Hmm:
    """States that stay, and emissions that differ at random from the frequencies of the symbols."""
    rng = np.random.default_rng(SEED)
    frequency = np.full(symbols, 0.5)
    own = vocabulary.symbol >= 0
    frequency[vocabulary.symbol[own]] += vocabulary.count[own]
    frequency[HOT:] += 10.0**vocabulary.class_log
    emit = frequency[:, None] * rng.gamma(1.5, 1.0, (symbols, states)) + 0.01
    even = np.full(states, 1 / states)
    return Hmm(even, np.full((states, states), 0.1 / states) + 0.9 * np.eye(states), emit / emit.sum(axis=0), even)


def _runs(symbols: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all texts, and (begin, size) of their runs with a mark for those that begin a text."""
    flat, ends = symbols.flatten().to_numpy(), np.cumsum([0, *symbols.value_lengths().to_pylist()])
    begin = [np.arange(a, b, length) for a, b in zip(ends[:-1], ends[1:])]
    first = np.concatenate([np.arange(len(b)) == 0 for b in begin])
    last = np.repeat(ends[1:], [len(b) for b in begin])
    begin = np.concatenate(begin)
    return flat, np.stack([begin, np.minimum(length, last - begin)], axis=1), first


def expected(model: Hmm, flat: np.ndarray, runs: np.ndarray, first: np.ndarray, emit: np.ndarray, move: np.ndarray, start: np.ndarray) -> None:
    """Add the expected counts of some runs (longest first) to ``emit``, ``move`` and ``start``."""
    begin, size = runs[:, 0], runs[:, 1]
    steps, states = int(size[0]), len(model.start)
    active = np.searchsorted(-size, -np.arange(1, steps + 1), side="right")
    coded = [flat[begin[:n] + t] for t, n in enumerate(active)]
    seen = [model.emit[c] for c in coded]
    alpha, scale = [], []
    now = np.where(first[:, None], model.start, model.usual)
    for t, n in enumerate(active):
        a = now[:n] * seen[t]
        s = a.sum(axis=1, keepdims=True)
        a /= s
        alpha.append(a)
        scale.append(s)
        now = a @ model.move
    beta = np.ones((len(size), states))
    for t in range(steps - 1, -1, -1):
        n = active[t]
        state = alpha[t] * beta[:n]
        if t == 0:
            start += state[first[:n]].sum(axis=0)
        else:
            ahead = seen[t] * beta[:n] / scale[t]
            move += model.move * (alpha[t - 1][:n].T @ ahead)
            beta[:n] = ahead @ model.move.T
        alpha[t] = state
    codes, states_of = np.concatenate(coded), np.concatenate(alpha)
    for k in range(states):
        emit[:, k] += np.bincount(codes, states_of[:, k], minlength=len(emit))


def train_round(coded: DataFrame, model: Hmm) -> Hmm:
    """One Baum-Welch round over all training texts."""
    symbols, states = model.emit.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit, move, start = np.zeros((symbols, states)), np.zeros((states, states)), np.zeros(states)
        for batch in batches:
            if not batch.num_rows:
                continue
            flat, runs, first = _runs(batch.column("symbols"), RUN)
            order = np.argsort(-runs[:, 1], kind="stable")
            for at in range(0, len(order), RUNS):
                some = order[at : at + RUNS]
                expected(model, flat, runs[some], first[some], emit, move, start)
        blocks = [(b, emit[b * _BLOCK : (b + 1) * _BLOCK].tobytes()) for b in range(-(-symbols // _BLOCK))]
        blocks.append((-1, np.vstack([start, move]).tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks])], names=["block", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(pdf["sums"].iloc[0]).copy()
        for x in pdf["sums"].iloc[1:]:
            total += np.frombuffer(x)
        return pd.DataFrame({"block": pdf["block"].iloc[:1], "sums": [total.tobytes()]})

    schema = "block int, sums binary"
    root = max(1, math.isqrt(coded.sparkSession.sparkContext.defaultParallelism)) * 4
    sums = arrow(coded.select("symbols"), run, schema).withColumn("part", F.spark_partition_id() % root)
    sums = sums.groupBy("block", "part").applyInPandas(add, schema).groupBy("block").applyInPandas(add, schema)
    emit, move, start = np.zeros((symbols, states)), np.zeros((states, states)), np.zeros(states)
    for row in sums.toLocalIterator():
        found = np.frombuffer(row["sums"]).reshape(-1, states)
        if row["block"] < 0:
            start, move = found[0], found[1:]
        else:
            emit[row["block"] * _BLOCK : row["block"] * _BLOCK + len(found)] = found
    usual = emit.sum(axis=0) + 1e-3
    emit = emit + 0.05
    return Hmm((start + 0.1) / (start + 0.1).sum(), (move + 0.1) / (move + 0.1).sum(axis=1, keepdims=True), emit / emit.sum(axis=0), usual / usual.sum())


def _forward(model: Hmm, flat: np.ndarray, begin: np.ndarray, size: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the recursion predicts after each run, and the natural logs of the scale. Runs come longest first."""
    now, logs = start.copy(), np.zeros(len(begin))
    active = np.searchsorted(-size, -np.arange(1, int(size[0]) + 1), side="right")
    for t, n in enumerate(active):
        a = now[:n] * model.emit[flat[begin[:n] + t]]
        if t % 8 == 7 or n < len(begin) or t == len(active) - 1:
            s = a.sum(axis=1)
            a /= s[:, None]
            logs[:n] += np.log(s)
        now[:n] = a @ model.move
    left = now.sum(axis=1)
    return now / left[:, None], logs + np.log(left)


def log_likelihoods(model: Hmm, symbols: pa.Array) -> np.ndarray:
    """Natural log of the probability of each symbol sequence."""
    states = len(model.start)
    flat, runs, first = _runs(symbols, CHUNK_LEN)
    owner = np.cumsum(first) - 1
    many = np.bincount(owner)
    total, now = np.zeros(len(many)), np.tile(model.start, (len(many), 1))
    after = np.empty((len(runs), states, states))
    logs = np.empty((len(runs), states))

    def blocks(index: np.ndarray, width: int) -> Iterator[np.ndarray]:
        index = index[np.argsort(-runs[index, 1], kind="stable")]
        for at in range(0, len(index), max(1, width)):
            yield index[at : at + width]

    for some in blocks(np.flatnonzero(many[owner] == 1), 2048):
        _, total[owner[some]] = _forward(model, flat, runs[some, 0], runs[some, 1], now[owner[some]])
    for some in blocks(np.flatnonzero(many[owner] > 1), 2048 // states):
        again = np.repeat(some, states)
        out, log = _forward(model, flat, runs[again, 0], runs[again, 1], np.tile(np.eye(states), (len(some), 1)))
        after[some], logs[some] = out.reshape(-1, states, states), log.reshape(-1, states)
    place = np.arange(len(runs)) - np.flatnonzero(first)[owner]
    for step in range(int(many.max()) if (many > 1).any() else 0):
        at = np.flatnonzero((place == step) & (many[owner] > 1))
        weights = now[owner[at]]
        peak = logs[at].max(axis=1)
        mixed = weights * np.exp(logs[at] - peak[:, None])
        ahead = np.einsum("ri,rij->rj", mixed, after[at])
        s = ahead.sum(axis=1)
        now[owner[at]] = ahead / s[:, None]
        total[owner[at]] += peak + np.log(s)
    return total


def _scores(model: Hmm):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep = ["__k1", "__k2", "doc_id", "held_out", "n_tokens", "n_known", "base", "share"]
        for batch in batches:
            if batch.num_rows:
                found = log_likelihoods(model, batch.column("symbols")) / math.log(10)
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(found)], names=[*keep, "forward"])

    return run


def score(docs: DataFrame, rounds: int = ROUNDS, states: int = STATES, known: int = KNOWN) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row; logs have base 10."""
    rows = keyed(docs).select("__k1", "__k2", F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    counts = store(word_counts(rows.where("NOT held_out")), "op7-counts")
    words = vocabulary(counts, known=known)
    coded = store(arrow(rows, _encode(words), _CODED), "op7-symbols")
    model = first_guess(words, states)
    for _ in range(rounds):
        model = train_round(coded.where("NOT held_out"), model)
    first = arrow(coded.drop("rest"), _scores(model), _CODED.split(", symbols")[0] + ", forward double")
    per_text = first.groupBy("__k1", "__k2").agg(
        F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "base", "share", "forward")])
    far = coded.select("__k1", "__k2", F.explode("rest").alias("x")).select("__k1", "__k2", "x.w", "x.n")
    far = far.join(counts.select("w", F.col("n").alias("c")), "w")
    far = far.groupBy("__k1", "__k2").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("logs"), F.sum("n").alias("more"))
    both = per_text.join(far, ["__k1", "__k2"], "left")
    logs = F.coalesce(F.col("logs") / F.col("copies"), F.lit(0.0))
    more = F.coalesce(F.col("more") / F.col("copies"), F.lit(0.0)).cast("long")
    return both.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + more).alias("n_known"), F.lit(words.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs).alias("base_score"), (F.col("forward") + F.col("share") + logs).alias("score"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")

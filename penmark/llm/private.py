"""Operator 13, personal data by a skip-chain conditional random field.

1. *Base spans* are found by fixed patterns (:func:`base_spans`): email, ip, card, phone. They always stay.
2. *Nodes* are the words ``[^\\x20\\x09-\\x0D]+`` that hold a digit or an ``@``; no other word can carry an entity label. Each node has one of the labels
   none, email, ip, card, phone, with a potential that is linear in its features: its shape, its number of digits, whether it is a valid card number
   or address, the shapes of the words beside it and the word before it.
3. *Edges*: neighbouring words that are both nodes share a chain potential. However far apart, each node shares a skip potential with the
   last node before it that is the same word, and with the last one that is similar (the same seven or more digits, the same name before
   an ``@``). Linking each occurrence to the last one only keeps edges linear in nodes.
4. *Message passing*: loopy sum-product with ``STEPS`` parallel rounds over all edges of a document gives marginals, so the evidence of one
   occurrence reaches the others.
5. *Training*: labels are the base spans of at most ``TRAIN`` documents (about; chosen by a hash, among those that hold a digit or an ``@``); nodes that
   may repeat an entity without being a base span are left out (:func:`trusted`). Gradients (observed minus expected counts under the marginals) are summed over partitions for each of ``ROUNDS`` steps.
6. *Added spans*: neighbouring nodes of one label whose marginal is at least ``SURE`` and that touch no base span, without the
   punctuation around them. An added span has the number of digits that its kind asks for (an email: an ``@`` or a linked name).

Null and empty texts have no spans. Rows are independent of each other once the model is fitted, so a null ``doc_id``, repeated rows and extra columns
change nothing. Without any base span in the table nothing is learnt and nothing is added. Memory of a task: one text and its nodes.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from penmark.llm.common import arrow, slices, store

KINDS = ("email", "ip", "card", "phone")
LABELS, NONE = 1 + len(KINDS), 0
CHAIN, SAME, SIMILAR = 0, 1, 2
TRAIN, ROUNDS, STEPS, RATE, DECAY, SURE = 8192, 40, 12, 0.2, 1e-4, 0.9
BUCKETS = 256  # of every hashed feature
FEATURES = 6  # of a node
WIDTH = FEATURES * BUCKETS

_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?+[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NUMBERS = str.maketrans({c: "0" for c in "0123456789"})
_RUNS = re.compile(r"([A-Za-z\u0080-\U0010ffff]+)|(0+)|([^A-Za-z0\u0080-\U0010ffff])\3*")
_DIGITS = re.compile("[^0-9]+")


def luhn(digits: str) -> bool:
    odd, even = digits[::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def address(parts: list[str]) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in parts)


def _emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            floor = domain.end()
            yield start, floor
        at = text.find("@", domain.end() if domain else at + 1)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` in code points, in order; ``kind`` counts from 1 as in :data:`KINDS`. Time is linear in the text."""
    out = [(s, 1, e) for s, e in _emails(text)] if "@" in text else []
    for m in _IP.finditer(text):
        if address(m[0].split(".")):
            out.append((m.start(), 2, m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12 and 12 <= len(digits := _DIGITS.sub("", m[0])) <= 19 and luhn(digits):
            out.append((m.start(), 3, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append((m.start(), 4, m.end()))
    return sorted(out)


def listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k - 1]}:{s}:{e}" for s, k, e in spans)


def shape(word: str) -> str:
    """Letters as ``a``, digits as ``0``, runs shortened to one: ``+0``, ``0.0.0.0``, ``a.0@a.a``."""
    return _RUNS.sub(lambda m: "a" if m[1] else "0" if m[2] else m[3], word[:64].translate(_NUMBERS))


def _bucket(field: int, value: str) -> int:
    return field * BUCKETS + zlib.crc32(value.encode("utf-8", "replace")) % BUCKETS


class Graph:
    """Nodes and edges of one text. ``first, last``: code points of a node's word. ``number``: the word's number in the text."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        space = (points == 32) | ((points >= 9) & (points <= 13))
        edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
        begin, end = edge[0::2], edge[1::2]
        telling = np.concatenate(([0], np.cumsum((points == 64) | ((points >= 48) & (points <= 57)))))
        self.number = np.flatnonzero(telling[end] > telling[begin])
        self.first, self.last = begin[self.number], end[self.number]
        word = [text[a:b] for a, b in zip(self.first.tolist(), self.last.tolist())]
        numbers = self.number.tolist()
        around = lambda i: text[begin[i] : min(end[i], begin[i] + 64)] if 0 <= i < len(begin) else ""
        self.features = np.empty((len(word), FEATURES), np.int64)
        edges, seen = [], {}
        for k, (w, n) in enumerate(zip(word, numbers)):
            digits = _DIGITS.sub("", w)
            parts = w.strip(".,;:!?()[]\"'").split(".")
            valid = ("c" if 12 <= len(digits) <= 19 and luhn(digits) else "") + ("i" if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts) and address(parts) else "")
            before, after = around(n - 1), around(n + 1)
            fields = (shape(w), f"{min(len(digits), 20)} {'@' in w} {valid}", shape(before), shape(after), before.lower(), "")
            self.features[k] = [_bucket(f, v) for f, v in enumerate(fields)]
            if k and numbers[k - 1] == n - 1:
                edges.append((k - 1, k, CHAIN))
            for kind, key in self._keys(w, digits):
                other = seen.get(key)
                if other is not None and other != k:
                    edges.append((other, k, kind))
                seen[key] = k
        self.edges = np.array(sorted(set(edges)), np.int64).reshape(-1, 3)

    @staticmethod
    def _keys(word: str, digits: str) -> set[tuple[int, str]]:
        name = word.strip(".,;:!?()[]<>\"'#$%&*").lower()
        keys = {(SAME, name)} if len(name) >= 5 else set()
        if len(digits) >= 7:
            keys.add((SIMILAR, digits))
        local = name.split("@")[0]
        if len(local) >= 5:
            keys.add((SIMILAR, "@" + local))
        return keys

    def labels(self, spans: list[tuple[int, int, int]]) -> np.ndarray:
        """The kind of the longest base span that touches each node."""
        out, longest = np.zeros(len(self.first), np.int64), np.zeros(len(self.first), np.int64)
        for s, k, e in spans:
            lo, hi = np.searchsorted(self.last, s, side="right"), np.searchsorted(self.first, e)
            here = np.arange(lo, hi)
            here = here[longest[lo:hi] < e - s]
            out[here], longest[here] = k, e - s
        return out


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(unary: np.ndarray, edges: np.ndarray, pairwise: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Loopy sum-product: log marginals of nodes ``(n, LABELS)`` and of edges ``(e, LABELS, LABELS)``; exact on trees no deeper than ``steps``."""
    source, target = np.concatenate((edges[:, 0], edges[:, 1])), np.concatenate((edges[:, 1], edges[:, 0]))
    count = len(edges)
    reverse = np.concatenate((np.arange(count) + count, np.arange(count)))
    own = pairwise[edges[:, 2]]
    potential = np.concatenate((own, own.transpose(0, 2, 1)))
    message = np.zeros((2 * count, LABELS))
    belief = unary

    def gather() -> np.ndarray:
        return unary + np.stack([np.bincount(target, message[:, x], len(unary)) for x in range(LABELS)], axis=1)

    for _ in range(steps if count else 0):
        message = _logsum((belief[source] - message[reverse])[:, :, None] + potential, 1)
        message -= _logsum(message, 1)[:, None]
        belief = gather()
    nodes = belief - _logsum(belief, 1)[:, None]
    pairs = (belief[source[:count]] - message[reverse[:count]])[:, :, None] + (belief[target[:count]] - message[:count])[:, None, :] + own
    return nodes, pairs - _logsum(pairs.reshape(count, -1), 1)[:, None, None] if count else pairs


class Model:
    """``unary``: weights of features by label. ``pairwise``: potentials of the three kinds of edges; skip potentials are symmetric."""

    def __init__(self, unary: np.ndarray | None = None, pairwise: np.ndarray | None = None):
        self.unary = np.zeros((WIDTH, LABELS)) if unary is None else unary
        self.pairwise = np.zeros((3, LABELS, LABELS)) if pairwise is None else pairwise

    def potentials(self, features: np.ndarray) -> np.ndarray:
        return self.unary[features].sum(axis=1)

    def gradient(self, features: np.ndarray, edges: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """Observed minus expected counts, as one vector, and the number of nodes at its end."""
        nodes, pairs = marginals(self.potentials(features), edges, self.pairwise)
        rest = np.eye(LABELS)[labels] - np.exp(nodes)
        unary = np.zeros_like(self.unary)
        for column in features.T:
            np.add.at(unary, column, rest)
        both = -np.exp(pairs)
        both[np.arange(len(edges)), labels[edges[:, 0]], labels[edges[:, 1]]] += 1
        pairwise = np.zeros_like(self.pairwise)
        np.add.at(pairwise, edges[:, 2], both)
        pairwise[1:] += pairwise[1:].transpose(0, 2, 1).copy()
        return np.concatenate((unary.ravel(), pairwise.ravel(), [len(labels)]))


def trusted(graph: Graph, labels: np.ndarray) -> np.ndarray:
    """Nodes whose label is fit to learn from. One without a base span may still be the repetition of an entity: runs of such nodes that share a
    skip edge with a labelled node are left out."""
    new = np.concatenate(([True], (np.diff(graph.number) != 1) | (np.diff(labels) != 0))) if len(labels) else np.zeros(0, bool)
    run = np.cumsum(new)
    skip = graph.edges[graph.edges[:, 2] != CHAIN]
    doubtful = [run[skip[:, i]][(labels[skip[:, i]] == NONE) & (labels[skip[:, 1 - i]] != NONE)] for i in (0, 1)]
    return ~np.isin(run, np.concatenate(doubtful))


def _training_graphs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            graph = Graph(text)
            labels = graph.labels(base_spans(text))
            keep = trusted(graph, labels)
            if keep.any():
                edges = graph.edges[keep[graph.edges[:, 0]] & keep[graph.edges[:, 1]]]
                edges[:, :2] = (np.cumsum(keep) - 1)[edges[:, :2]]
                rows.append((graph.features[keep].ravel(), edges.ravel(), labels[keep]))
        columns = list(zip(*rows)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.list_(pa.int64())) for c in columns], ["features", "edges", "labels"])


def _gradients(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            features, edges, labels = (batch.column(c).flatten().to_numpy() for c in ("features", "edges", "labels"))
            sizes = np.diff(batch.column("labels").offsets.to_numpy()).astype(np.int64)
            links = np.diff(batch.column("edges").offsets.to_numpy()).astype(np.int64) // 3
            edges = edges.reshape(-1, 3).copy()
            edges[:, :2] += np.repeat(np.cumsum(sizes) - sizes, links)[:, None]
            own = model.gradient(features.reshape(-1, FEATURES), edges, labels)
            total = own if total is None else total + own
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["gradient"])

    return run


def fit(docs: DataFrame, train: int = TRAIN, rounds: int = ROUNDS) -> Model:
    """Weights learnt from the base spans of about ``train`` documents; each round sums one gradient over the partitions."""
    able = docs.where(F.col("text").rlike("[0-9@]")).select("text")
    count = able.count()
    model = Model()
    if not count:
        return model
    share = min(1.0, train / count)
    chosen = able.where(F.pmod(F.xxhash64("text", F.lit(13)), F.lit(1 << 30)) < int(share * (1 << 30)))
    graphs = store(arrow(chosen, _training_graphs, "features array<bigint>, edges array<bigint>, labels array<bigint>"), "private-graphs")
    mean = np.zeros(model.unary.size + model.pairwise.size)
    square = mean.copy()
    weights = mean.copy()
    for step in range(1, rounds + 1):
        parts = arrow(graphs, _gradients(model), "gradient array<double>").collect()
        if not parts:
            return model
        total = np.sum([p.gradient for p in parts], axis=0)
        slope = total[:-1] / total[-1] - DECAY * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.99 * square + 0.01 * slope**2
        weights = weights + RATE * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-6)
        model = Model(weights[: model.unary.size].reshape(WIDTH, LABELS), weights[model.unary.size :].reshape(3, LABELS, LABELS))
    return model


def _fits(kind: int, text: str) -> bool:
    digits = len(_DIGITS.sub("", text))
    return (len(text) >= 5, digits >= 4 and text.count(".") == 3, 12 <= digits <= 19, 7 <= digits <= 15)[kind - 1]


def added_spans(text: str, graph: Graph, base: list[tuple[int, int, int]], model: Model, sure: float = SURE) -> list[tuple[int, int, int]]:
    """Spans of nodes that the model labels and that touch no base span."""
    if not len(graph.first):
        return []
    chances = np.exp(marginals(model.potentials(graph.features), graph.edges, model.pairwise)[0])
    best = chances.argmax(axis=1)
    best[(chances.max(axis=1) < sure) | (graph.labels(base) > 0)] = NONE
    out, k = [], 0
    while k < len(best):
        end = k + 1
        while best[k] and end < len(best) and best[end] == best[k] and graph.number[end] == graph.number[end - 1] + 1:
            end += 1
        if best[k]:
            first, last = int(graph.first[k]), int(graph.last[end - 1])
            while first < last and not (text[first].isalnum() or text[first] in "+("):
                first += 1
            while first < last and not text[last - 1].isalnum():
                last -= 1
            if _fits(int(best[k]), text[first:last]):
                out.append((first, int(best[k]), last))
        k = end
    return out


SCHEMA = (
    "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_added bigint, "
    "redacted string"
)


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Every span replaced by its kind; overlapping spans by the kind of the first."""
    out, at = [], 0
    for s, k, e in spans:
        if s >= at:
            out += [text[at:s], f"<{KINDS[k - 1]}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def find(docs: DataFrame, model: Model, sure: float = SURE) -> DataFrame:
    """One row per document, as :data:`SCHEMA`: numbers of base spans by kind, all spans, and the text without them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                yield _found(part, model, sure)

    return arrow(docs.select("doc_id", "text"), run, SCHEMA)


def _found(batch: pa.RecordBatch, model: Model, sure: float) -> pa.RecordBatch:
    rows = []
    for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
        text = text or ""
        base, added = [], []
        if re.search("[0-9@]", text):
            base = base_spans(text)
            if model.unary.any():
                added = added_spans(text, Graph(text), base, model, sure)
        spans = sorted(base + added)
        kinds = [k for _, k, _ in base]
        rows.append((
            doc_id, *(kinds.count(k) for k in range(1, LABELS)), hashlib.sha256(listed(base).encode()).hexdigest(), listed(spans), len(added),
            redact(text, spans),
        ))
    fields = [f.split() for f in SCHEMA.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    kinds = {"bigint": pa.int64(), "string": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])

"""Personal data by patterns and a skip-chain conditional random field.

Patterns find the base spans: e-mail addresses, IP addresses, card and phone numbers. All other
number runs and words with an @ are candidates. Candidates and base spans of a document are the
nodes of a random field: neighbours are linked in a chain, and nodes that are equal or alike (the
same last digits, the same address) are linked over any distance: each to one node that stands for the
group, so that any two of them are two steps apart, however many there are.
Sum-product messages pass along both kinds of links until they settle; base spans are clamped to their kind. A
candidate becomes a span of a kind if its marginal says so and links of likeness connect it to a
base span of that kind, so that one document labels the same thing the same way.

The weights are fitted by pseudo-likelihood on a bounded sample, with the base spans as labels. The
features leave out the signs by which the patterns decide (the plus, the check digit, the dots), so
the field can go beyond them.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperlane.llm.tasks import map_texts, slices

KINDS = ("email", "ip", "card", "phone")
OTHER = 0  # label 0 is no personal data, label i is KINDS[i - 1]
LABELS = len(KINDS) + 1

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# the same matches as without the look-behind, but a run of digits is tried only once
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NUMBER = re.compile(r"[0-9][0-9\x20().-]*[0-9]")
NO_GAP = re.compile(r"[^\s@]++")
WORD_BEFORE = re.compile(r"(\w{1,40})\W{0,8}\Z")
NOT_DIGIT = re.compile(r"[^0-9]+")

ALIKE_DIGITS = 7
CHAIN_GAP = 200
CONTEXTS = 32
FEATURES = 2 + 7 + 5 + 3 + CONTEXTS
SAMPLE_DOCUMENTS, SAMPLE_NODES = 4_000, 40_000
ROUNDS, DAMPING, THRESHOLD = 200, 0.3, 0.5  # messages settle long before, unless they swing
CLAMP = 30.0


def luhn(digits: str) -> bool:
    """Check digit of card numbers."""
    doubled = (2 * int(d) for d in digits[-2::-2])
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in doubled)) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Spans of addresses, found from each @ outwards, so that a long run is read only once."""
    done = 0
    at = text.find("@")
    while at >= 0:
        if at > done and text[at - 1] in LOCAL and (domain := DOMAIN.match(text, at + 1)):
            start = at - 1
            while start > done and text[start - 1] in LOCAL:
                start -= 1
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Spans of words around a single @, of any length, found from each @ outwards."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] != "@" and not text[start - 1].isspace():
            start -= 1
        if start < at and (word := NO_GAP.match(text, at + 1)):
            done = word.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of the four patterns as (start, end, label), by start, then by kind."""
    found = [(start, end, 1) for start, end in emails(text)]
    for m in IP.finditer(text):
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in (x.lstrip("0") for x in m[0].split("."))):
            found.append((m.start(), m.end(), 2))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 3))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15:
            found.append((m.start(), m.end(), 4))
    return sorted(found, key=lambda s: (s[0], s[2]))


@dataclass
class Graph:
    """Nodes of some documents, and their links."""

    spans: list[tuple[int, int]]
    document: list[int]
    label: np.ndarray  # of base spans, else -1
    features: np.ndarray
    chain: np.ndarray  # pairs of nodes
    alike: np.ndarray


def describe(text: str, start: int, end: int) -> np.ndarray:
    """Features of a span: signs, number of digits and separators, and the word before it."""
    out = np.zeros(FEATURES, dtype=np.float32)
    piece = text[start:end]
    n = len(NOT_DIGIT.sub("", piece))
    out[0] = 1
    out[1] = "@" in piece
    out[2 + int(np.searchsorted((1, 7, 9, 12, 16, 20), n, "right"))] = 1
    out[9 + min(4, len(piece) // 8)] = 1
    out[14:17] = "-" in piece, " " in piece, "(" in piece
    if before := WORD_BEFORE.search(text[max(0, start - 48) : start]):
        out[17 + zlib.crc32(before[1].lower().encode()) % CONTEXTS] = 1
    return out


def likeness(text: str, start: int, end: int) -> str | None:
    """What alike spans have in common: the last digits, or an address without its last parts."""
    piece = text[start:end]
    if "@" in piece:
        name, _, host = piece.lower().strip(".,;:()<>[]\"'").partition("@")
        return f"{name}@{host.partition('.')[0]}"
    digits = NOT_DIGIT.sub("", piece)
    return digits[-ALIKE_DIGITS:] if len(digits) >= ALIKE_DIGITS else None


def graph(texts: list[str]) -> Graph:
    """Nodes and links of documents; a document costs time in proportion to its length."""
    spans, document, label, features, chain, alike = [], [], [], [], [], []
    for d, text in enumerate(texts):
        base = base_spans(text)
        nodes = [(s, e, k) for s, e, k in base]
        taken = sorted((s, e) for s, e, _ in base)
        ends, top = [], 0
        for _, e in taken:
            top = max(top, e)
            ends.append(top)
        starts = [s for s, _ in taken]
        if "@" in text or any(c in text for c in "0123456789"):
            others = [(m.start(), m.end()) for m in NUMBER.finditer(text) if len(NOT_DIGIT.sub("", m[0])) >= ALIKE_DIGITS]
            others += addresses(text)
            for s, e in others:
                i = int(np.searchsorted(starts, e, "left"))
                if i == 0 or ends[i - 1] <= s:
                    nodes.append((s, e, -1))
        nodes.sort()
        last: dict[str, int] = {}
        for j, (s, e, k) in enumerate(nodes):
            here = len(spans)
            spans.append((s, e))
            document.append(d)
            label.append(k)
            features.append(describe(text, s, e))
            if j and s - nodes[j - 1][1] <= CHAIN_GAP:
                chain.append((here - 1, here))
            key = likeness(text, s, e)
            if key is not None:
                if key in last:
                    alike.append((last[key], here))
                last[key] = here
    pairs = lambda x: np.array(x, dtype=np.int64).reshape(len(x), 2)
    return Graph(spans, document, np.array(label, dtype=np.int64), np.array(features).reshape(len(spans), FEATURES), pairs(chain), pairs(alike))


def groups(g: Graph) -> np.ndarray:
    """Number of the group of alike nodes that each node belongs to; links lead to later nodes."""
    group = np.arange(len(g.spans))
    for a, b in g.alike.tolist():
        group[b] = group[a]
    return group


@dataclass
class Weights:
    """Log potentials: features by label, label by next label, label by alike label."""

    unary: np.ndarray
    chain: np.ndarray
    alike: np.ndarray


def log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def marginals(g: Graph, w: Weights, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of all nodes by loopy message passing."""
    belief = (g.features @ w.unary).astype(np.float64)
    known = np.flatnonzero(g.label >= 0)
    belief[known, g.label[known]] += CLAMP
    # a node for each group of alike nodes, without features of its own
    group = groups(g)
    members = np.flatnonzero(np.bincount(group, minlength=len(group))[group] > 1)
    hubs, hub = np.unique(group[members], return_inverse=True)
    own = len(belief)
    belief = np.vstack([belief, np.zeros((len(hubs), LABELS))])
    alike = np.column_stack([members, own + hub])
    edges = np.vstack([g.chain, alike])
    if len(edges):
        forward = np.concatenate([np.repeat(w.chain[None], len(g.chain), 0), np.repeat(w.alike[None], len(alike), 0)])
        source = np.concatenate([edges[:, 0], edges[:, 1]])
        target = np.concatenate([edges[:, 1], edges[:, 0]])
        tables = np.concatenate([forward, forward.transpose(0, 2, 1)])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        messages = np.zeros((len(source), LABELS))
        for _ in range(rounds):
            total = belief.copy()
            np.add.at(total, target, messages)
            new = log_sum((total[source] - messages[back])[:, :, None] + tables, 1)
            new -= log_sum(new, 1)[:, None]
            moved = np.abs(new - messages).max()
            messages = DAMPING * messages + (1 - DAMPING) * new
            if moved < 1e-4:
                break
        np.add.at(belief, target, messages)
    belief = belief[:own]
    return np.exp(belief - log_sum(belief, 1)[:, None])


def training_rows(g: Graph) -> tuple[np.ndarray, np.ndarray]:
    """Label and inputs of each node with a certain label: features, labels before, after and alike.

    A candidate that is like a base span has no certain label; any other candidate is OTHER.
    """
    group = groups(g)
    claimed = np.isin(group, group[g.label >= 0])
    label = np.where(g.label >= 0, g.label, np.where(claimed, -1, OTHER))
    around = np.zeros((len(label), 3 * LABELS), dtype=np.float32)
    for place, a, b in ((0, g.chain[:, 1], g.chain[:, 0]), (1, g.chain[:, 0], g.chain[:, 1]), (2, g.alike[:, 0], g.alike[:, 1]), (2, g.alike[:, 1], g.alike[:, 0])):
        sure = label[b] >= 0
        np.add.at(around, (a[sure], place * LABELS + label[b[sure]]), 1)
    sure = label >= 0
    return label[sure], np.hstack([g.features, around])[sure]


def fit(labels: np.ndarray, inputs: np.ndarray, steps: int = 300, rate: float = 1.0, decay: float = 1e-3) -> Weights:
    """Pseudo-likelihood weights: each label given the features and the labels around it."""
    w = np.zeros((FEATURES + 3 * LABELS, LABELS))
    if len(labels):
        truth = np.eye(LABELS)[labels]
        # alike spans agree: counts beyond one tell nothing new
        x = np.minimum(inputs, 1.0).astype(np.float64)
        for _ in range(steps):
            scores = x @ w
            chance = np.exp(scores - log_sum(scores, 1)[:, None])
            w -= rate * (x.T @ (chance - truth) / len(labels) + decay * w)
    before, after, alike = (w[FEATURES + i * LABELS : FEATURES + (i + 1) * LABELS] for i in range(3))
    return Weights(w[:FEATURES], (before + after.T) / 2, (alike + alike.T) / 2)


def learn(df: DataFrame, text: str, documents: int = SAMPLE_DOCUMENTS, nodes: int = SAMPLE_NODES) -> Weights:
    """Fit the field on about ``documents`` rows, picked by the hash of their text, and at most
    ``nodes`` of their nodes. Only fitting uses a sample."""
    share = max(1, df.count() // documents)
    hashed = F.xxhash64(text)
    rows = df.select(F.col(text).alias("text"), hashed.alias("key")).filter((F.pmod("key", F.lit(share)) == 0) & F.col("text").isNotNull())

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(1).to_pylist(), batch.column(0).to_pylist(), strict=True):
                labels, inputs = training_rows(graph([text]))
                if len(labels):
                    columns = [pa.array([key] * len(labels)), pa.array(range(len(labels)), pa.int32()), pa.array(labels, pa.int32()), pa.array([x.tobytes() for x in inputs], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "place", "label", "inputs"])

    found = rows.mapInArrow(extract, "key bigint, place int, label int, inputs binary")
    sample = found.dropDuplicates(["key", "place"]).orderBy("key", "place").limit(nodes).collect()
    inputs = np.array([np.frombuffer(r["inputs"], dtype=np.float32) for r in sample])
    return fit(np.array([r["label"] for r in sample], dtype=np.int64), inputs)


def find(texts: list[str], w: Weights, threshold: float = THRESHOLD) -> list[list[tuple[int, int, int, bool]]]:
    """Spans of each text as (start, end, label, whether a pattern found it), by start, then kind."""
    g = graph(texts)
    found: list[list] = [[] for _ in texts]
    if not g.spans:
        return found
    group = groups(g)
    claims = {(int(group[i]), int(g.label[i])) for i in np.flatnonzero(g.label >= 0)}
    open_nodes = len(g.alike) and (g.label < 0).any()
    best = marginals(g, w) if open_nodes else None
    for i, (start, end) in enumerate(g.spans):
        if g.label[i] >= 0:
            found[g.document[i]].append((start, end, int(g.label[i]), True))
        elif best is not None:
            k = int(best[i].argmax())
            if k != OTHER and best[i, k] >= threshold and (int(group[i]), k) in claims:
                found[g.document[i]].append((start, end, k, False))
    for spans in found:
        spans.sort(key=lambda s: (s[0], s[2]))
    return found


def mask(text: str, spans: Sequence[tuple[int, int, int, bool]]) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first one."""
    out, done = [], 0
    for start, end, k, _ in spans:
        if start >= done:
            out += [text[done:start], f"[{KINDS[k - 1].upper()}]"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def detect(
    df: DataFrame, text: str, weights: Weights, spans: str = "spans", masked: str | None = None,
    keep: Sequence[str] | None = None, threshold: float = THRESHOLD,
) -> DataFrame:
    """Add the spans of personal data of each whole text, and on request the masked text.

    A span has its kind, start and end (code points, end exclusive) and whether a pattern found it.
    A missing or empty text has none; its masked text stays as it is. Columns of the same names are
    replaced; rows are handled one by one, so repeated rows stay.
    """
    added = {spans: "array<struct<kind: string, start: int, end: int, base: boolean>>"}
    if masked is not None:
        added[masked] = "string"

    def start():
        def work(texts: list[str]) -> list[list]:
            found = [x for group in slices(texts, 1 << 20) for x in find(group, weights, threshold)]
            columns = [[[{"kind": KINDS[k - 1], "start": s, "end": e, "base": b} for s, e, k, b in x] for x in found]]
            if masked is not None:
                columns.append([mask(t, x) for t, x in zip(texts, found, strict=True)])
            return columns

        return work

    return map_texts(df, text, added, start, keep)

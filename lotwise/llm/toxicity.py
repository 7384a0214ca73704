"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

Words are runs of letters. The network reads, for each word, word and character inputs: how strongly the word and its
letter groups (three to six letters, with marks for both ends) go with toxic training documents, and its length. It runs
over windows of 32 words, a new one every 24, so neighbours overlap and every word is inside; attention pools the states
of both directions to one logit per window. A document scores as its worst window, on a logistic curve whose 0.3 is the
best cut of the training documents, which is the threshold of ``predicted``.

Training takes at most ``sample`` documents of each label, those with the smallest hashes of their ids, of at most
``MAX_CHARS`` characters; they are read by the driver. Everything else covers all rows and whole texts. Inputs of
training documents come from the other half of them, so that the network does not learn to trust rare words. A document
marks only its worst window, found anew before every round.

Null and empty texts are one empty window and get a score. Repeated rows repeat their score, further columns pass
through, columns with the names of the outputs are replaced. Without both labels every score is 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotwise.llm.batches import appended, letter_words, mixed
from lotwise.llm.quality import sampled

#: Training documents of both labels together, and the length up to which a document can be one.
SAMPLE, MAX_CHARS = 3_000, 20_000
CUT = 0.3
WINDOW, STEP = 32, 24
BUCKETS = 1 << 17
INPUTS, HIDDEN = 6, 8
ROUNDS, PASSES, BATCH, RATE = 4, 6, 64, 0.01
#: Training documents taken apart at once.
DOCS = 64


def letter_groups(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the groups of three to six letters of words, and the word of each."""
    sizes = ends - starts + 2
    begin = np.concatenate([[0], np.cumsum(sizes)])
    word = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(begin[-1]) - begin[word]
    source = np.clip(starts[word] + place - 1, 0, len(points) - 1)
    marked = np.where((place > 0) & (place < sizes[word] - 1), points[source], 1).astype(np.uint64)
    found, owner = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    value = np.zeros(len(marked), np.uint64)
    with np.errstate(over="ignore"):
        for width in range(1, 7):
            here = len(marked) - width + 1
            if here <= 0:
                break
            value = value[:here] * np.uint64(0x100000001B3) + marked[width - 1 :] + np.uint64(1)
            if width >= 3:
                fits = word[:here] == word[width - 1 :]
                found.append((mixed(value[fits] + np.uint64(width)) & np.uint64(BUCKETS - 1)).astype(np.int64))
                owner.append(word[:here][fits])
    return np.concatenate(found), np.concatenate(owner)


class Words:
    """The words of some texts: the distinct ones with their buckets, and the windows as numbers of distinct words."""

    def __init__(self, texts: list[str]):
        points, starts, ends, owner, hashes = letter_words(texts)
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        self.word = (distinct & np.uint64(BUCKETS - 1)).astype(np.int64)
        groups, self.of = letter_groups(points, starts[at], ends[at])
        order = np.argsort(self.of, kind="stable")
        self.groups, self.of = groups[order].astype(np.int32), self.of[order].astype(np.int32)
        self.length = (ends - starts)[at]
        sizes = np.bincount(owner, minlength=len(texts))
        begin = np.concatenate([[0], np.cumsum(sizes)])
        count = np.maximum(1, -(-np.maximum(sizes - WINDOW, 0) // STEP) + 1)
        self.doc = np.repeat(np.arange(len(texts)), count)
        turn = np.arange(len(self.doc)) - np.repeat(np.cumsum(count) - count, count)
        place = turn[:, None] * STEP + np.arange(WINDOW)[None, :]
        self.real = place < sizes[self.doc][:, None]
        # Beyond the end of a text stands a word of its own, number len(distinct), whose inputs are zero.
        source = np.minimum(begin[self.doc][:, None] + place, max(len(which) - 1, 0))
        padded = which if len(which) else np.zeros(1, np.int64)
        self.windows = np.where(self.real, padded[source], len(distinct)).astype(np.int32)
        self.which, self.owner = which, owner

    def inputs(self, word_table: np.ndarray, group_table: np.ndarray) -> np.ndarray:
        rows = np.zeros((len(self.word) + 1, INPUTS), np.float32)
        if len(self.word):
            values = group_table[self.groups]
            first = np.flatnonzero(np.diff(self.of, prepend=-1))
            rows[:-1, 0] = word_table[self.word]
            rows[:-1, 1] = np.maximum.reduceat(values, first)
            rows[:-1, 2] = np.minimum.reduceat(values, first)
            rows[:-1, 3] = np.add.reduceat(values, first) / np.diff(first, append=len(values))
            rows[:-1, 4] = np.log(self.length) / 2 - 0.8
            rows[:-1, 5] = 1.0
        return rows


def counted(words: Words, label: np.ndarray, used: np.ndarray) -> np.ndarray:
    """For words and for letter groups, by bucket: used documents that have it, and toxic ones among them."""
    pairs = np.unique(words.owner.astype(np.int64) * (len(words.word) + 1) + words.which)
    doc, word = pairs // (len(words.word) + 1), pairs % (len(words.word) + 1)
    doc, word = doc[used[doc]], word[used[doc]]
    first = np.searchsorted(words.of, np.arange(len(words.word) + 1))
    counts = first[word + 1] - first[word]
    run = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    grouped = np.unique(np.repeat(doc, counts) * BUCKETS + words.groups[np.repeat(first[word], counts) + run])
    sides = ((doc, words.word[word]), (grouped // BUCKETS, grouped % BUCKETS))
    return np.array([[np.bincount(bucket, minlength=BUCKETS), np.bincount(bucket, weights=label[owner], minlength=BUCKETS)] for owner, bucket in sides])


def leanings(counts: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """By bucket, for words and for letter groups: how far it occurs in more toxic documents than chance, in deviations."""
    tables = []
    for every, toxic in counts:
        far = (toxic - every * prior) / np.sqrt(every * prior * (1 - prior) + 1)
        tables.append((np.clip(far, -6, 9) / 3).astype(np.float32))
    return tables[0], tables[1]


def bend(x: np.ndarray) -> np.ndarray:
    """The squashing function of all gates: x / (1 + |x|)."""
    return x / (1 + np.abs(x))


class Network:
    """Weights by name: for each direction ``W`` (inputs to gates) and ``U`` (state to gates); attention ``v``; output ``w``, ``b``."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights

    @classmethod
    def fresh(cls, random: np.random.Generator) -> Network:
        weights = {}
        for side in ("f", "r"):
            weights["W" + side] = random.normal(0, 0.4, (INPUTS, 3 * HIDDEN))
            weights["U" + side] = random.normal(0, 0.3, (HIDDEN, 3 * HIDDEN))
        weights |= {"v": random.normal(0, 0.5, 2 * HIDDEN), "w": random.normal(0, 0.5, 2 * HIDDEN), "b": np.zeros(1)}
        return cls({name: value.astype(np.float32) for name, value in weights.items()})

    def _states(self, inputs: np.ndarray, windows: np.ndarray, keep: bool):
        """States of both directions (window, place, unit); with ``keep`` also what the gradient needs."""
        states = np.empty((len(windows), WINDOW, 2 * HIDDEN), np.float32)
        kept: dict[str, list] = {"f": [], "r": []}
        for side, places in (("f", range(WINDOW)), ("r", range(WINDOW - 1, -1, -1))):
            gates_in = inputs @ self.weights["W" + side]
            u = self.weights["U" + side]
            h = np.zeros((len(windows), HIDDEN), np.float32)
            half = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, None)
            for place in places:
                outer = gates_in[windows[:, place]]
                inner = h @ u
                gates = 0.5 + 0.5 * bend(outer[:, : 2 * HIDDEN] + inner[:, : 2 * HIDDEN])
                z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
                n = bend(outer[:, 2 * HIDDEN :] + r * inner[:, 2 * HIDDEN :])
                if keep:
                    kept[side].append((place, h, z, r, n, inner[:, 2 * HIDDEN :]))
                h = n + z * (h - n)
                states[:, place, half] = h
        return states, kept

    def _pooled(self, states, real):
        e = states @ self.weights["v"]
        e = np.where(real, e, -1e4)
        a = np.exp(e - e.max(axis=1, keepdims=True)) * real
        a /= np.maximum(a.sum(axis=1, keepdims=True), 1e-9)
        return a, np.einsum("nt,nth->nh", a, states)

    def logits(self, inputs: np.ndarray, windows: np.ndarray, real: np.ndarray) -> np.ndarray:
        result = np.empty(len(windows), np.float32)
        for at in range(0, len(windows), 4096):
            part = slice(at, at + 4096)
            states, _ = self._states(inputs, windows[part], False)
            _, pooled = self._pooled(states, real[part])
            result[part] = pooled @ self.weights["w"] + self.weights["b"][0]
        return result

    def gradient(self, inputs, windows, real, label, weight) -> dict[str, np.ndarray]:
        states, kept = self._states(inputs, windows, True)
        a, pooled = self._pooled(states, real)
        logit = pooled @ self.weights["w"] + self.weights["b"][0]
        d_logit = ((1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label) * weight / weight.sum()).astype(np.float32)
        d_pooled = d_logit[:, None] * self.weights["w"]
        d_a = np.einsum("nh,nth->nt", d_pooled, states)
        d_e = a * (d_a - (a * d_a).sum(axis=1, keepdims=True))
        d_states = a[:, :, None] * d_pooled[:, None, :] + d_e[:, :, None] * self.weights["v"]
        found = {"w": pooled.T @ d_logit, "b": d_logit.sum(keepdims=True), "v": np.einsum("nt,nth->h", d_e, states)}
        for side in ("f", "r"):
            half = slice(0, HIDDEN) if side == "f" else slice(HIDDEN, None)
            u = self.weights["U" + side]
            d_w, d_u = np.zeros_like(self.weights["W" + side]), np.zeros_like(u)
            d_h = np.zeros((len(windows), HIDDEN), np.float32)
            for place, h, z, r, n, inner in reversed(kept[side]):
                d_h = d_h + d_states[:, place, half]
                d_n = d_h * (1 - z) * (1 - np.abs(n)) ** 2
                d_z = d_h * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
                d_r = d_n * inner * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
                d_w += inputs[windows[:, place]].T @ np.concatenate([d_z, d_r, d_n], axis=1)
                d_inner = np.concatenate([d_z, d_r, d_n * r], axis=1)
                d_u += h.T @ d_inner
                d_h = d_h * z + d_inner @ u.T
            found["W" + side], found["U" + side] = d_w, d_u
        return found


@dataclass(frozen=True)
class Model:
    network: Network
    word_table: np.ndarray
    group_table: np.ndarray
    cut: float
    slope: float

    def score(self, texts: list[str]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        words = Words(texts)
        worst = np.full(len(texts), -np.inf)
        np.maximum.at(worst, words.doc, self.network.logits(words.inputs(self.word_table, self.group_table), words.windows, words.real))
        shift = np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(self.slope * (worst - self.cut) + shift, -40, 40)))


def fit(texts: list[str], labels: list[int], seed: int = 11) -> Model | None:
    label = np.array(labels, np.float64)
    if not (label == 1).any() or not (label == 0).any():
        return None
    random = np.random.default_rng(seed)
    fold = random.permutation(len(texts)) % 2
    # A few documents at a time, so that the memory follows the sample's bound and not its letter groups.
    starts = range(0, len(texts), DOCS)
    parts = [Words(texts[at : at + DOCS]) for at in starts]

    def tables(used: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = sum(counted(part, label[at : at + DOCS], used[at : at + DOCS]) for at, part in zip(starts, parts))
        return leanings(counts, label[used].mean() if used.any() else 0.5)

    sides = [np.concatenate([part.inputs(*both) for part in parts]) for both in (tables(fold != side) for side in (0, 1))]
    # One table of inputs: part after part, and all of them once for each half of the documents.
    inputs = np.concatenate(sides)
    begin = np.cumsum([0, *(len(part.word) + 1 for part in parts)])
    doc_of = np.concatenate([part.doc + at for at, part in zip(starts, parts)])
    real = np.concatenate([part.real for part in parts])
    windows = np.concatenate([part.windows + shift for part, shift in zip(parts, begin)])
    windows = windows + (fold[doc_of] * len(sides[0]))[:, None]
    network = Network.fresh(random)
    step = {name: (np.zeros_like(value), np.zeros_like(value)) for name, value in network.weights.items()}
    weight = np.where(label == 1, (label == 0).sum() / (label == 1).sum(), 1.0) ** 0.5
    first = np.searchsorted(doc_of, np.arange(len(texts)))
    ranked = inputs[:, :2].sum(axis=1)[windows].max(axis=1)
    turn = 0
    for _ in range(ROUNDS):
        by = np.lexsort((-ranked, doc_of))
        worst = by[first]
        for _ in range(PASSES):
            # Besides its worst window a clean document shows a random one.
            spare = np.flatnonzero(label[doc_of] == 0)
            shown = np.concatenate([worst, random.choice(spare, min(len(spare), len(texts) // 3))])
            random.shuffle(shown)
            for at in range(0, len(shown), BATCH):
                part = shown[at : at + BATCH]
                doc = doc_of[part]
                slopes = network.gradient(inputs, windows[part], real[part], label[doc], weight[doc])
                turn += 1
                for name, slope in slopes.items():
                    mean, square = step[name]
                    slope = np.clip(slope, -1, 1) + 1e-4 * network.weights[name]
                    mean += 0.1 * (slope - mean)
                    square += 0.01 * (slope**2 - square)
                    network.weights[name] -= (RATE * mean / (1 - 0.9**turn) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-6)).astype(np.float32)
        ranked = network.logits(inputs, windows, real)
    logit = np.full(len(texts), -np.inf)
    np.maximum.at(logit, doc_of, ranked)
    word_table, group_table = tables(np.ones(len(texts), bool))
    return Model(network, word_table, group_table, _best_cut(logit, label), 1.0)


def _best_cut(logit: np.ndarray, label: np.ndarray) -> float:
    """The middle of the gap at which precision and recall are best together."""
    order = np.argsort(-logit, kind="stable")
    hits = np.cumsum(label[order])
    quality = 2 * hits / (np.arange(1, len(order) + 1) + label.sum())
    best = int(np.argmax(quality))
    below = logit[order][min(best + 1, len(order) - 1)]
    return float((logit[order][best] + below) / 2)


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model | None:
    marks = labels.select(key, label).distinct().where(F.col(label).isin(0, 1))
    short = docs.where(F.col(text).isNotNull() & (F.length(text) <= MAX_CHARS)).select(key, F.xxhash64(text).alias("_own"), F.col(text).alias("_text"))
    # An id with its text is one document, however many rows repeat it, so the bound holds for what comes to the driver.
    ids = short.select(key, "_own").join(marks, key).distinct()
    picked = sampled(ids, key, label, sample)
    rows = short.join(picked, [key, "_own"]).select("_text", label, key, "_own").dropDuplicates([key, "_own", label])
    rows = sorted((row[0], row[1]) for row in rows.collect())  # the order in which tasks end must not matter
    return fit([row[0] for row in rows], [row[1] for row in rows])


def scored(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with ``score`` and ``predicted``."""

    def compute(texts: list[str]) -> dict:
        # Rounded, as the last digits of a product depend on what else is in the batch: equal texts score alike.
        score = np.zeros(len(texts)) if model is None else np.round(model.score(texts), 5)
        return {"score": score, "predicted": (score >= CUT).astype(np.int32)}

    return appended(df, text, compute, "score double, predicted int")

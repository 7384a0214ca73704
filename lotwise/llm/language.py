"""Language identification: script ranges narrow the candidates, Viterbi over words labels spans.

Each run of letters is a word. Its score in a language is the mean log-likelihood ratio of its letter groups (one to four
letters, with marks for both ends) under smoothed counts; groups are hashed into a table of fixed size. Only languages
in whose training texts a script is at home are candidates for words in it; a script that none knows leaves all of them.
A path over the words of a text pays a penalty for each change of language; its runs are the labelled spans.

``lang_pred`` is the language with most letters in the spans, ties to the first name; ``score`` is the share of letters
it holds, weighted by how far its words' scores stand above the runner-up. A null text, or one without letters, is
``und`` with score 0 and no spans; so is every text if nothing was learned. Repeated rows repeat their result, further
columns pass through, and columns with the names of the outputs are replaced.

Training takes at most ``sample`` documents of each language, those with the smallest hashes of their ids; what comes
to the driver are counts of table size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lotwise.llm.batches import appended, chunks, letter_words, mixed, texts_of

SAMPLE = 1_500
BUCKETS = 1 << 16
SWITCH = 4.0
UNKNOWN = "und"
#: First code points of blocks of scripts, in order; number 0 is Latin and everything not listed.
SCRIPTS = (
    (0x0000, 0), (0x0370, 1), (0x0400, 2), (0x0530, 3), (0x0590, 4), (0x0600, 5), (0x0700, 0), (0x0750, 5), (0x0780, 0),
    (0x0900, 6), (0x0980, 7), (0x0A00, 8), (0x0A80, 9), (0x0B80, 10), (0x0C00, 11), (0x0C80, 12), (0x0D00, 13),
    (0x0E00, 14), (0x0E80, 0), (0x10A0, 15), (0x1100, 16), (0x1200, 17), (0x13A0, 0), (0x1F00, 1), (0x2000, 0),
    (0x3040, 18), (0x3100, 19), (0x3130, 16), (0x3190, 19), (0x31F0, 18), (0x3400, 19), (0xA000, 0), (0xAC00, 16),
    (0xD7B0, 0), (0xF900, 19), (0xFB00, 0), (0x20000, 19),
)
N_SCRIPTS = 20
BLOCK_DOCS = 256


def script_of(points: np.ndarray) -> np.ndarray:
    starts = np.array([start for start, _ in SCRIPTS])
    return np.array([script for _, script in SCRIPTS])[np.searchsorted(starts, points, side="right") - 1]


def groups_of(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the letter groups of words, and the word of each."""
    sizes = ends - starts + 2
    begin = np.concatenate([[0], np.cumsum(sizes)])
    word = np.repeat(np.arange(len(starts)), sizes)
    place = np.arange(begin[-1]) - begin[word]
    source = starts[word] + place - 1
    marked = np.where((place > 0) & (place < sizes[word] - 1), points[np.clip(source, 0, len(points) - 1)], 1).astype(np.uint64)
    found, owner = [], []
    with np.errstate(over="ignore"):
        value = np.zeros(len(marked), np.uint64)
        for width in range(1, 5):
            here = len(marked) - width + 1
            if here <= 0:
                break
            value = value[:here] * np.uint64(0x100000001B3) + marked[width - 1 :] + np.uint64(1)
            fits = (word[:here] == word[width - 1 :]) if width > 1 else (place > 0) & (place < sizes[word] - 1)
            found.append((mixed(value[fits] + np.uint64(width)) & np.uint64(BUCKETS - 1)).astype(np.int64))
            owner.append(word[:here][fits])
    return (np.concatenate(found), np.concatenate(owner)) if found else (np.empty(0, np.int64), np.empty(0, np.int64))


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    table: np.ndarray  # log-likelihood by bucket and language, less the mean over languages
    home: np.ndarray  # by script and language, whether the script is at home

    def word_scores(self, points, starts, ends) -> np.ndarray:
        buckets, owner = groups_of(points, starts, ends)
        count = np.maximum(np.bincount(owner, minlength=len(starts)), 1)
        scores = np.empty((len(starts), len(self.names)))
        for i in range(len(self.names)):
            scores[:, i] = np.bincount(owner, weights=self.table[buckets, i], minlength=len(starts))
        # Longer words say more, but not in proportion to their overlapping groups.
        scores /= np.sqrt(count)[:, None]
        return np.where(self.home[script_of(points[starts])], scores, -30.0)

    def label(self, texts: list[str]) -> dict:
        """Prediction, score and spans (start, end, language) in code points of the lower-cased text, per text."""
        count = len(texts)
        result = {"lang_pred": [UNKNOWN] * count, "score": np.zeros(count), "spans": [[] for _ in range(count)]}
        if not self.names:
            return result
        points, starts, ends, owner, hashes = letter_words(texts)
        if not len(starts):
            return result
        _, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        distinct = self.word_scores(points, starts[at], ends[at])
        sizes = np.bincount(owner, minlength=count)
        begin = np.concatenate([[0], np.cumsum(sizes)])
        path = np.empty(len(starts), np.int64)
        order = np.argsort(-sizes, kind="stable")
        order = order[sizes[order] > 0]
        for block in range(0, len(order), BLOCK_DOCS):
            docs = order[block : block + BLOCK_DOCS]
            self._paths(distinct, which, begin, sizes, docs, path)
        text_start = np.concatenate([[0], np.cumsum(np.fromiter((len(t.replace("Σ", "σ").lower()) + 1 for t in texts), np.int64, count))])
        letters = (ends - starts).astype(np.float64)
        margin = np.sort(distinct, axis=1)
        margin = (margin[:, -1] - margin[:, -2])[which] if len(self.names) > 1 else np.ones(len(which))
        sure = 0.5 + 0.5 * np.tanh(margin)
        held = np.zeros((count, len(self.names)))
        np.add.at(held, (owner, path), letters)
        total = held.sum(axis=1)
        best = held.argmax(axis=1)
        own = path == best[owner]
        weight = np.bincount(owner[own], weights=(letters * sure)[own], minlength=count)
        edge = np.flatnonzero(np.diff(path, prepend=-1) | np.diff(owner, prepend=-1))
        last = np.append(edge[1:], len(path)) - 1
        for first, stop in zip(edge.tolist(), last.tolist()):
            doc = int(owner[first])
            base = int(text_start[doc])
            result["spans"][doc].append({"start": int(starts[first]) - base, "stop": int(ends[stop]) - base, "lang": self.names[path[first]]})
        for doc in np.flatnonzero(total > 0).tolist():
            result["lang_pred"][doc] = self.names[best[doc]]
        result["score"] = np.divide(weight, total, out=np.zeros(count), where=total > 0)
        return result

    def _paths(self, distinct, which, begin, sizes, docs, path) -> None:
        """Viterbi for a block of texts side by side, longest first; texts that have ended drop out at the end."""
        size = sizes[docs]
        value = np.zeros((len(docs), len(self.names)))
        stayed, top = [], []
        for step in range(size[0]):
            alive = int(np.searchsorted(-size, -step, side="left"))
            now = value[:alive]
            best = now.argmax(axis=1)
            limit = now[np.arange(alive), best] - SWITCH
            stay = now >= limit[:, None]
            value[:alive] = np.maximum(now, limit[:, None]) + distinct[which[begin[docs[:alive]] + step]]
            stayed.append(stay)
            top.append(best)
        state = value.argmax(axis=1)
        for step in range(size[0] - 1, -1, -1):
            alive = len(top[step])
            here = state[:alive]
            path[begin[docs[:alive]] + step] = here
            state[:alive] = np.where(stayed[step][np.arange(alive), here], here, top[step])


COUNTS = "lang string, kind int, slot int, n bigint"


def trained(df: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> Model:
    """A model from the documents with a language; give only those it may learn from."""
    ids = df.where(F.col(lang).isNotNull()).select(key, lang).distinct()
    counts = dict(map(tuple, ids.groupBy(lang).count().collect()))  # one row a language
    names = sorted(counts)
    if not names:
        return Model((), np.zeros((BUCKETS, 0), np.float32), np.zeros((N_SCRIPTS, 0), bool))
    # The smallest hashes of each language: of the share that holds them for certain, as good as, the exact first ones.
    shares = [(name, min(1.0, (1.2 * sample + 200) / count)) for name, count in counts.items()]
    shares = df.sparkSession.createDataFrame(shares, f"`{lang}` string, _share double")
    hash_ = F.xxhash64(key)
    low = ids.join(F.broadcast(shares), lang).where(hash_.cast("double") <= F.col("_share") * 2.0**64 - 2.0**63).drop("_share")
    place = Window.partitionBy(lang).orderBy(hash_, key)
    picked = low.withColumn("_place", F.row_number().over(place)).where(F.col("_place") <= sample).drop("_place")
    texts = df.select(key, lang, text).join(picked, [key, lang]).select(F.col(lang).alias("lang"), F.col(text).cast("string").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: dict[str, np.ndarray] = {}
        scripts: dict[str, np.ndarray] = {}
        for batch in batches:
            for piece in chunks(batch, 1):
                langs = np.array(piece.column(0).to_pylist(), dtype=object)
                points, starts, ends, owner, _ = letter_words(texts_of(piece.column(1)))
                for name in set(langs.tolist()):
                    own = langs[owner] == name
                    buckets, _ = groups_of(points, starts[own], ends[own])
                    groups[name] = groups.get(name, 0) + np.bincount(buckets, minlength=BUCKETS)
                    scripts[name] = scripts.get(name, 0) + np.bincount(script_of(points[starts[own]]), minlength=N_SCRIPTS)
        for kind, tables in ((0, groups), (1, scripts)):
            for name, table in tables.items():
                slots = np.flatnonzero(table)
                columns = [pa.array([name] * len(slots)), pa.array(np.full(len(slots), kind, np.int32)), pa.array(slots.astype(np.int32)), pa.array(table[slots])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "kind", "slot", "n"])

    counted = texts.mapInArrow(count, COUNTS).groupBy("lang", "kind", "slot").agg(F.sum("n").alias("n")).toArrow()
    table, home = np.zeros((BUCKETS, len(names))), np.zeros((N_SCRIPTS, len(names)))
    where = {name: i for i, name in enumerate(names)}
    column = np.array([where[name] for name in counted.column("lang").to_pylist()], int)
    kind, slot, n = (counted.column(name).to_numpy() for name in ("kind", "slot", "n"))
    table[slot[kind == 0], column[kind == 0]] = n[kind == 0]
    home[slot[kind == 1], column[kind == 1]] = n[kind == 1]
    likely = np.log(table + 0.5) - np.log(table.sum(axis=0) + 0.5 * BUCKETS)
    share = home / np.maximum(home.sum(axis=0), 1)
    known = share >= 0.02
    known[~known.any(axis=1)] = True
    return Model(tuple(names), (likely - likely.mean(axis=1, keepdims=True)).astype(np.float32), known)


def identified(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred``, ``score`` and ``spans``."""
    return appended(df, text, model.label, "lang_pred string, score double, spans array<struct<start:int,stop:int,lang:string>>")

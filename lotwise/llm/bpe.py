"""BPE encoding and decoding: speculate and verify.

Each distinct word of a chunk is cut greedily into its longest vocabulary entries. That proposal is the merge result if
and only if every two neighbours are compatible, that is, if merging them alone would leave them as they are: all pairs
of all words are tested together, by undoing merges on both sides of the boundary, latest first, and looking for a merge
across it that would have come earlier. Only words that fail are merged step by step.

The vocabulary file is one of the public tokenizers' ``json`` files: byte-level symbols, an optional word-end suffix,
NFC, white space and case rules as that file states for its kind. Null and empty texts give no tokens. Repeated rows
repeat their result; other columns pass through, and columns named like the outputs are replaced. The text is encoded
whole; a special token's string inside it becomes that token, as in the tokenizers library.
"""

from __future__ import annotations

import itertools
import json
import re
import unicodedata
from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from lotwise.llm.batches import appended, points_of, range_hashes, weighted

SCHEMA = "token_ids binary, decoded string"
#: Cached words per task; beyond it the cache starts anew.
CACHE_WORDS = 700_000
NO_RANK = np.int64(1 << 40)


def encode(df: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """``df`` with ``token_ids`` (unsigned 32-bit little-endian numbers) and ``decoded`` (the ids read back as text).

    ``vocabulary`` is a path that every executor can read, or the name of a file of the ``public_tokenizers`` package.
    """

    def compute(texts: list[str]) -> dict:
        codec = codec_of(vocabulary)
        ids = codec.encode(texts)
        return {"token_ids": [one.tobytes() for one in ids], "decoded": [codec.decode(one) for one in ids]}

    return appended(df, text, compute, SCHEMA)


@cache
def codec_of(vocabulary: str) -> Codec:
    if "/" not in vocabulary:
        import public_tokenizers

        vocabulary = public_tokenizers.path(vocabulary)
    with open(vocabulary, encoding="utf-8") as file:
        return Codec(json.load(file))


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself if printable in Latin-1, else the next from U+0100."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(byte) if byte in plain else chr(next(spare)) for byte in range(256)]


@cache
def kinds() -> np.ndarray:
    """For every code point: 0 white space, 1 letter, 2 number, 3 other."""
    table = np.full(0x110000, 3, np.int8)
    for i in range(0x110000):
        category = unicodedata.category(chr(i))
        if category[0] == "L":
            table[i] = 1
        elif category[0] == "N":
            table[i] = 2
        elif category[0] == "Z" or i in (9, 10, 11, 12, 13, 0x85):
            table[i] = 0
    return table


class Codec:
    def __init__(self, file: dict):
        model = file["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {item["content"]: item["id"] for item in file["added_tokens"]}
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.vocab: dict[str, int] = model["vocab"]
        names = self.vocab | self.special
        self.written = [""] * (max(names.values()) + 1)
        for name, number in names.items():
            self.written[number] = name
        self.symbols = byte_symbols()
        pairs = [tuple(rule.split(" ")) if isinstance(rule, str) else tuple(rule) for rule in model["merges"]]
        left = np.array([self.vocab[a] for a, _ in pairs], np.int64)
        right = np.array([self.vocab[b] for _, b in pairs], np.int64)
        made = np.array([self.vocab[a + b] for a, b in pairs], np.int64)
        ranks = np.arange(1, len(pairs) + 1)
        size = len(self.written)
        # Rank 0: a symbol that no merge makes. A split of such a token is the token itself.
        self.rank, self.left, self.right = np.zeros(size, np.int64), np.arange(size), np.arange(size)
        self.rank[made], self.left[made], self.right[made] = ranks, left, right
        if len(np.unique(made)) != len(made) or np.any(np.maximum(self.rank[left], self.rank[right]) >= ranks):
            raise ValueError("every merge must make a token of its own from tokens of earlier merges")
        keys = left * size + right
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], ranks[order]
        self.made = np.concatenate([[0], made])  # by rank
        self.usable = self._usable(left, right, made, ranks)
        self.reach: dict[str, int] = {}  # length of the longest usable token, by its first three symbols
        for name in self.usable:
            self.reach[name[:3]] = max(self.reach.get(name[:3], 0), len(name))
        self.forget()

    def forget(self) -> None:
        self.known: dict[int, int] = {}  # hash of a word: its number
        self.flat = np.empty(0, "<u4")  # tokens of the words, one after the other
        self.bounds = np.zeros(1, np.int64)  # where the tokens of each word begin

    def _usable(self, left, right, made, ranks) -> dict[str, int]:
        """The tokens that merging their own symbols gives back; only these are proposed."""
        fine = np.zeros(len(self.written), bool)
        fine[self.rank == 0] = True
        whole = self.compatible(left, right, ranks)
        for a, b, m, ok in zip(left.tolist(), right.tolist(), made.tolist(), whole.tolist()):
            fine[m] = ok and fine[a] and fine[b]
        return {name: number for name, number in self.vocab.items() if fine[number]}

    def compatible(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
        """Whether no merge across the boundary between ``a`` and ``b`` comes before ``limit`` and before their own."""
        size = len(self.written)
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), NO_RANK) if limit is None else limit.copy()
        good = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            key = x * size + y
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            across = np.where(self.keys[place] == key, self.key_ranks[place], NO_RANK)
            bad = across < limit[open_]
            good[open_[bad]] = False
            rx, ry = self.rank[x], self.rank[y]
            # Undo the later of the two merges. At equal ranks the left one was first, so the right one is undone.
            undo_left = rx > ry
            a[open_] = np.where(undo_left, self.right[x], x)
            b[open_] = np.where(undo_left, y, self.left[y])
            # Left of an equal rule the boundary wins only if earlier; right of it, also if equal.
            limit[open_] = np.minimum(limit[open_], np.where(undo_left, rx, ry + 1))
            open_ = open_[~bad & (np.maximum(rx, ry) > 0)]
        return good

    def _normal(self, text: str) -> str:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # each character by itself: no final sigma

    def _words(self, texts: list[str]):
        """Code points; starts, ends and text numbers of the words, in order."""
        points, first = points_of(texts)
        kind = kinds()[points]
        edge = np.empty(len(kind) + 1, bool)
        edge[0] = edge[-1] = True
        edge[1:-1] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        bounds = np.flatnonzero(edge)
        starts, ends = bounds[:-1].copy(), bounds[1:].copy()
        # A lone apostrophe takes s, t, m, d, re, ve or ll from the letters that follow.
        mark = np.flatnonzero((points[starts] == 39) & (ends - starts == 1))
        mark = mark[mark + 1 < len(starts)]
        if len(mark):
            one = points[starts[mark + 1]]
            two = points[np.minimum(starts[mark + 1] + 1, len(points) - 1)]
            short = np.isin(one, [ord(c) for c in "stmd"])
            pair = ((two == ord("e")) & np.isin(one, [ord("r"), ord("v")])) | ((one == ord("l")) & (two == ord("l")))
            taken = np.where(short, 1, np.where(pair & (ends[mark + 1] - starts[mark + 1] > 1), 2, 0))
            taken[kind[starts[mark + 1]] != 1] = 0
            ends[mark] += taken
            starts[mark + 1] += taken
        keep = (kind[bounds[:-1]] != 0) & (starts < ends)
        starts, ends = starts[keep], ends[keep]
        return points, starts, ends, np.searchsorted(first, starts, side="right") - 1

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Token numbers of each text, unsigned 32-bit little-endian."""
        parts: list[str] = []
        owner: list[int] = []
        special: list[int] = []
        for i, text in enumerate(texts):
            pieces = self.split.split(text) if "<|" in text else [text]
            for piece in pieces:
                number = self.special.get(piece, -1)
                parts.append("" if number >= 0 else self._normal(piece))
                owner.append(i)
                special.append(number)
        points, starts, ends, part = self._words(parts)
        hashes = range_hashes(weighted(points), starts, ends)
        distinct, at, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > CACHE_WORDS:
            self.forget()
        names = distinct.tolist()
        new = [k for k, value in enumerate(names) if value not in self.known]
        if new:
            words = [points[starts[at[k]] : ends[at[k]]].tobytes().decode("utf-32-le", "surrogatepass") for k in new]
            self.known.update(zip((names[k] for k in new), range(len(self.known), len(self.known) + len(new))))
            tokens, sizes = self.tokens_of(words)
            self.flat = np.concatenate([self.flat, tokens.astype("<u4")])
            self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(sizes)])
        number = np.fromiter(map(self.known.__getitem__, names), np.int64, len(names))[which]
        counts = self.bounds[number + 1] - self.bounds[number]
        begin = np.concatenate([[0], np.cumsum(counts)])
        stream = self.flat[np.repeat(self.bounds[number] - begin[:-1], counts) + np.arange(begin[-1])]
        cut = begin[np.searchsorted(part, np.arange(len(parts) + 1))]
        result: list[list[np.ndarray]] = [[] for _ in texts]
        for i, (text, number) in enumerate(zip(owner, special)):
            result[text].append(np.array([number], "<u4") if number >= 0 else stream[cut[i] : cut[i + 1]])
        return [one[0] if len(one) == 1 else np.concatenate(one) for one in result]

    def tokens_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of distinct words, one after the other, and their counts: proposed, verified, merged where that fails."""
        spelled = ["".join(map(self.symbols.__getitem__, word.encode("utf-8", "surrogatepass"))) for word in words]
        proposed = [self._greedy(word) for word in spelled]
        flat = np.fromiter(itertools.chain.from_iterable(proposed), np.int64)
        sizes = np.fromiter(map(len, proposed), np.int64, len(proposed))
        word = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(word[1:] == word[:-1])
        pairs, back = np.unique(flat[inner] * len(self.written) + flat[inner + 1], return_inverse=True)
        fine = self.compatible(pairs // len(self.written), pairs % len(self.written))[back]
        failed = np.zeros(len(words), bool)
        failed[word[inner[~fine]]] = True
        if failed.any():
            merged, which = self._merged([spelled[i] for i in np.flatnonzero(failed)])
            kept = ~failed[word]
            flat = np.concatenate([flat[kept], merged])
            word = np.concatenate([word[kept], np.flatnonzero(failed)[which]])
            order = np.argsort(word, kind="stable")
            flat, word = flat[order], word[order]
        return flat, np.bincount(word, minlength=len(words))

    def _greedy(self, word: str) -> list[int]:
        get, reach, tokens, at, size = self.usable.get, self.reach.get, [], 0, len(word)
        tail = word + self.suffix
        while at < size:
            longest = reach(tail[at : at + 3], 1)
            if at + longest >= len(tail) and (number := get(tail[at:])) is not None:
                tokens.append(number)
                break
            # Without a suffix of its own the last symbol could not end the word, so inner tokens stop before it.
            stop = min(at + longest, size - 1 if self.suffix else size)
            if stop <= at:
                tokens.append(self.vocab[tail[at:]])
                break
            while (number := get(word[at:stop])) is None:
                stop -= 1
            tokens.append(number)
            at = stop
        return tokens

    def _merged(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merging of many words at once: in each round every word applies its earliest rule wherever it fits."""
        vocab, suffix, size = self.vocab, self.suffix, len(self.written)
        tokens = np.array([n for word in words for n in [*map(vocab.__getitem__, word[:-1]), vocab[word[-1] + suffix]]])
        owner = np.repeat(np.arange(len(words)), [len(word) for word in words])
        done_tokens, done_owner = [], []
        while len(tokens):
            key = tokens[:-1] * size + tokens[1:]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.full(len(tokens), NO_RANK)
            rank[:-1] = np.where((self.keys[place] == key) & (owner[1:] == owner[:-1]), self.key_ranks[place], NO_RANK)
            first = np.flatnonzero(np.diff(owner, prepend=-1))
            lowest = np.repeat(np.minimum.reduceat(rank, first), np.diff(first, append=len(owner)))
            open_ = lowest < NO_RANK
            done_tokens.append(tokens[~open_])
            done_owner.append(owner[~open_])
            hit = np.flatnonzero(open_ & (rank == lowest))
            # Of fits that overlap (one symbol repeated), the first, third, fifth ... apply.
            run = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
            turn = np.arange(len(hit)) - np.repeat(run, np.diff(run, append=len(hit)))
            hit = hit[turn % 2 == 0]
            tokens[hit] = self.made[rank[hit]]
            open_[hit + 1] = False
            tokens, owner = tokens[open_], owner[open_]
        tokens, owner = np.concatenate(done_tokens), np.concatenate(done_owner)
        order = np.argsort(owner, kind="stable")
        return tokens[order], owner[order]

    def decode(self, ids: np.ndarray) -> str:
        """Entries as written in the vocabulary, joined by spaces: the file names no decoder that would do otherwise."""
        return " ".join(map(self.written.__getitem__, ids.tolist()))

"""Stretches of words that repeat with a period, found by block convolution.

Words are runs of characters other than ASCII white space. A run is a stretch whose smallest period q (words q apart are
identical) fits into it at least four times, of six words or more, that no neighbouring word extends.

1. Scales are powers of two. At scale B the words are cut into aligned blocks of B; every run with B <= q < 2B holds a
   block that occurs again q words further on, since 4q words have room for both wherever the borders fall.
2. Screen, which loses nothing: a block recurs within 2B words only if each of its words does.
3. Of the other blocks, the squared differences between block and the following 2B words are summed for all distances at
   once by a number-theoretic transform modulo a prime of 31 bits. The sum is zero for every occurrence.
4. Equal distances of neighbouring blocks are one seed. Its equality is checked word by word (a sum that is a multiple of
   the prime drops out there) and extended to both sides, by less than a block each.
5. A stretch found with several periods keeps the smallest: it divides the others and was found at its own scale.

Null and empty texts have no words, no runs and an empty collapsed text; repeated rows are rows of their own; an empty
table gives an empty result; columns called ``runs`` or ``collapsed`` are replaced. Memory follows the longest text.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import DataFrame

from lotwise.llm.batches import appended

LEAST, REPEATS = 6, 4
#: 15 * 2**27 + 1, whose multiplicative group 31 generates: transforms of up to 2**27 numbers.
PRIME, GENERATOR = 15 * 2**27 + 1, 31
SLAB = 1 << 19  # numbers transformed at once, but for a single longer block
FAR = np.iinfo(np.int64).max


@cache
def _roots(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order twice that."""
    step = pow(GENERATOR, (PRIME - 1) // (2 * half), PRIME)
    step = pow(step, -1, PRIME) if inverse else step
    powers = np.ones(half, np.uint64)
    known = 1
    while known < half:
        factor = np.uint64(pow(step, known, PRIME))
        powers[known : 2 * known] = powers[: min(known, half - known)] * factor % np.uint64(PRIME)
        known *= 2
    return powers


def forward(values: np.ndarray) -> np.ndarray:
    """Number-theoretic transform of each row, in bit-reversed order."""
    prime, rows, size = np.uint64(PRIME), *values.shape
    half = size // 2
    while half:
        pair = values.reshape(rows, -1, 2, half)
        one, two = pair[:, :, 0], pair[:, :, 1]
        values = np.stack([(one + two) % prime, (one + prime - two) * _roots(half, False) % prime], axis=2).reshape(rows, size)
        half //= 2
    return values


def backward(values: np.ndarray) -> np.ndarray:
    """The inverse of ``forward``."""
    prime, rows, size = np.uint64(PRIME), *values.shape
    half = 1
    while half < size:
        pair = values.reshape(rows, -1, 2, half)
        one, two = pair[:, :, 0], pair[:, :, 1] * _roots(half, True) % prime
        values = np.stack([(one + two) % prime, (one + prime - two) % prime], axis=2).reshape(rows, size)
        half *= 2
    return values * np.uint64(pow(size, -1, PRIME)) % prime


def occurrences(blocks: np.ndarray, following: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For blocks (rows of B numbers) and the 2B numbers after each: rows and distances from B to 2B - 1 of zero sums."""
    prime, size = np.uint64(PRIME), blocks.shape[1]
    reversed_ = np.zeros_like(following)
    reversed_[:, :size] = blocks[:, ::-1]
    products = backward(forward(reversed_) * forward(following) % prime)[:, size - 1 : 2 * size - 1]
    own = (blocks * blocks % prime).sum(axis=1, dtype=np.uint64)[:, None]
    sums = np.zeros((len(blocks), 2 * size + 1), np.uint64)
    np.cumsum(following * following % prime, axis=1, out=sums[:, 1:])
    other = sums[:, size : 2 * size] - sums[:, :size]
    rows, distances = np.nonzero((own + other + np.uint64(2) * (prime - products)) % prime == 0)
    return rows, distances + size


def _recurs(words: np.ndarray) -> np.ndarray:
    """How far each word is from its next occurrence."""
    order = np.argsort(words, kind="stable")
    gaps = np.full(len(words), FAR)
    same = words[order[1:]] == words[order[:-1]]
    gaps[order[:-1][same]] = (order[1:] - order[:-1])[same]
    return gaps


def _seeds(words: np.ndarray, blocks: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of every occurrence, by distance and block."""
    found = [], []
    step = max(1, SLAB // (2 * size))
    for at in range(0, len(blocks), step):
        part = blocks[at : at + step]
        start = part[:, None] * size
        rows, distances = occurrences(words[start + np.arange(size)], words[start + size + np.arange(2 * size)])
        found[0].append(part[rows])
        found[1].append(distances)
    if not found[0]:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    block, distance = np.concatenate(found[0]), np.concatenate(found[1])
    order = np.lexsort((block, distance))
    return block[order], distance[order]


def _agreeing(flags: np.ndarray) -> int:
    """How many values are true before the first that is not."""
    return int(flags.argmin()) if not flags.all() else len(flags)


def runs_of(words: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start and period.

    ``words`` holds the numbers of the words of several texts, each text followed by a number found nowhere else; no text
    has more than ``longest`` words.
    """
    count, found = len(words), {}
    scales = max(1, longest // REPEATS).bit_length()
    # So many numbers more, found nowhere else, that every block has its window.
    room = count + 4 * (1 << scales)
    fresh = int(words.max(initial=0)) + 1
    padded = np.concatenate([words, np.arange(fresh, fresh + room - count)]).astype(np.uint64)
    gaps = np.full(room - room % (1 << scales), FAR)
    gaps[:count] = _recurs(words)
    covered = np.full(room, -1)
    kept: list[tuple[int, int, int]] = []
    for scale in range(scales):
        size = 1 << scale
        if scale:
            gaps = np.maximum(gaps[0::2], gaps[1::2])
        block, distance = _seeds(padded, np.flatnonzero(gaps < 2 * size), size)
        first = np.ones(len(block), bool)
        first[1:] = (block[1:] != block[:-1] + 1) | (distance[1:] != distance[:-1])
        begin = np.flatnonzero(first)
        number = np.diff(np.append(begin, len(block)))
        start, distance = block[begin] * size, distance[begin]
        stop = start + number * size
        longenough = stop - start + 2 * (size - 1) + distance >= np.maximum(LEAST, REPEATS * distance)
        # Within a known run, whose period divides the distance, there is nothing new.
        owner = covered[start]
        known = np.array(kept or [(0, 0, 1)])[owner]
        old = (owner >= 0) & (distance % known[:, 2] == 0) & (known[:, 1] >= stop + distance)
        for s, e, d in np.column_stack([start, stop, distance])[longenough & ~old].tolist():
            if not np.array_equal(padded[s:e], padded[s + d : e + d]):
                continue
            low = max(0, s - size)
            s -= _agreeing((padded[low:s] == padded[low + d : s + d])[::-1])
            e += _agreeing(padded[e : e + size] == padded[e + d : e + d + size])
            if e + d - s >= max(LEAST, REPEATS * d):
                found[s, e + d] = min(d, found.get((s, e + d), d))
        new = [(s, e, d) for (s, e), d in found.items() if size <= d < 2 * size]
        for run in sorted(new, key=lambda run: run[1] - run[0]):
            covered[run[0] : run[1]] = len(kept)
            kept.append(run)
    return np.array(sorted((s, e, d) for (s, e), d in found.items()), np.int64).reshape(-1, 3)


def compute(texts: list[str]) -> dict:
    split = [text.encode("utf-8", "surrogatepass").split() for text in texts]
    table: dict[bytes, int] = {}
    numbers = [table.setdefault(word, len(table)) for words in split for word in [*words, None]]
    sizes = np.array([len(words) + 1 for words in split], np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    words = np.array(numbers, np.int64)
    words[first[1:] - 1] = len(table) + np.arange(len(texts))
    found = runs_of(words, int(sizes.max(initial=1)) - 1)
    owner = np.searchsorted(first, found[:, 0], side="right") - 1
    keep = np.zeros(len(words) + 1, np.int64)
    np.add.at(keep, found[:, 0] + found[:, 2], 1)
    np.add.at(keep, found[:, 1], -1)
    keep = np.cumsum(keep) == 0
    runs: list[list[dict]] = [[] for _ in texts]
    for text, (start, end, period) in zip(owner.tolist(), found.tolist()):
        runs[text].append({"start": start - int(first[text]), "length": end - start, "period": period})
    collapsed = []
    for text, own in enumerate(split):
        if runs[text]:
            own = [own[place] for place in np.flatnonzero(keep[first[text] : first[text + 1] - 1]).tolist()]
        collapsed.append(b" ".join(own).decode("utf-8", "surrogatepass"))
    return {"runs": runs, "collapsed": collapsed}


def with_runs(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``runs`` (start and period in words, length; by start and period) and ``collapsed``, the words joined
    by one space without those that a run holds after its first period."""
    return appended(df, text, compute, "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")

"""Personal data by candidate gradient boosting, in DataFrame functions only.

1. Generators propose spans, overlapping and with high recall: the four base patterns (e-mail, IP, card, phone) and four
   wide ones (spelled-out e-mail, IPv6, number groups without a plus sign as card or phone).
2. Base candidates that pass their check (ranges, Luhn, digit count) are spans as they stand.
3. The others are scored by boosted trees over format and context features. The trees learn from what the base patterns
   found in the same table: those that pass are positives, those that fail are negatives. The features say nothing about
   the checks. Features are bits, so the training data is the count of each (kind, bits, label): small for any table.
4. A span is selected above the lowest score of its kind at which the training cells keep the wanted precision; a kind
   without training cells is not extended. Selected spans that overlap a base span are dropped.

Offsets are code points, ends exclusive. A null text is empty, a text without candidates has no spans, an empty table
trains nothing; repeated rows repeat their spans, further columns pass through, ``pii_spans`` is replaced if it exists.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lotwise.sources.workspace import stage

KINDS = ("email", "ip", "card", "phone")
LOCAL = "[A-Za-z0-9._%+-]"
# Matches are as leftmost, non-overlapping search gives them; the looks behind only stop a failed start from being
# tried again at every later character of the same run.
BASE = {
    "email": rf"(?:\G|(?<!{LOCAL})){LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){11,18}+(?![ -]?[0-9])",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
WIDE = {
    "email": r"(?<![A-Za-z0-9])[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]) ?[A-Za-z0-9-]{1,63}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{1,63}){1,8}",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9.-])[0-9]{4}(?:(?:[.]| {2})[0-9]{4}){3}(?![0-9.])",
    "phone": r"(?<![0-9.+-])(?:\([0-9]{2,4}\) ?|[0-9]{2,4}[ .-])(?:[0-9]{2,4}[ .-]){1,3}[0-9]{3,4}(?![0-9.-])",
}
#: Text that every match contains, so that most texts are passed over without a search.
GATES = {"email": "@", "phone": "+"}
WIDE_GATES = {"email": r"[(\[]at[)\]]", "ip": r"[0-9A-Fa-f]:[0-9A-Fa-f]{1,4}:"}
BEFORE = 24
FEATURES = (
    ("names it", r"(?i)(?:mail|contact|ip|host|server|addr|card|visa|credit|pay|tel|phone|call|mobile|fax)[^A-Za-z]{0,6}[a-z]{0,4}\W{0,4}$"),
    ("numbered thing", r"(?i)(?:version|release|isbn|order|invoice|no|nr|id|v|#|\$|€)[^A-Za-z0-9]{0,3}$"),
    ("after a word", r"[\p{L},;] ?$"),
    ("after a sign", r"[^\p{L}\p{N}\s,;.]$"),
    ("after a number", r"[0-9][^A-Za-z]{0,3}$"),
    ("at the start", r"(?:^|\n)\s*$"),
)
FORMATS = (("spaces", r"\s"), ("brackets", r"[(\[]"), ("dots", r"\."), ("dashes", "-"), ("zero first", r"^\D?0"), ("one digit repeated", r"^\D*(\d)(?:\D*\1)*\D*$"))
ROUNDS, DEPTH, RATE = 40, 3, 0.3
PRECISION = 0.9
SPAN = "struct<kind:int,start:int,stop:int,base:boolean,passed:boolean,bits:int>"


def found(text: Column, pattern: str, gate: Column | None = None) -> Column:
    """(start, stop, hit, before) of each match."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    hits = hits if gate is None else F.when(gate, hits).otherwise(F.array().cast("array<string>"))
    # The list of one is a name for the hits, which would be searched for anew at each mention.
    return F.transform(F.array(hits), lambda hits: F.when(F.size(hits) > 0, _placed(text, hits, pattern)).otherwise(F.array().cast(PLACED)))[0]


PLACED = "array<struct<start:int,stop:int,hit:string,before:string>>"


def _placed(text: Column, hits: Column, pattern: str) -> Column:
    # The text between two matches and the matches in turn: their lengths add up to the offsets.
    between = F.split(text, pattern, -1)
    steps = F.zip_with(F.slice(between, 1, F.size(hits)), hits, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(PLACED).alias("out"))

    def add(done: Column, step: Column) -> Column:
        start = done["at"] + F.length(step["gap"])
        stop = start + F.length(step["hit"])
        one = F.struct(start.alias("start"), stop.alias("stop"), step["hit"].alias("hit"), F.right(step["gap"], F.lit(BEFORE)).alias("before"))
        return F.struct(stop.alias("at"), F.concat(done["out"], F.array(one)).alias("out"))

    return F.aggregate(steps, zero, add, lambda done: done["out"])


def digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def luhn(hit: Column) -> Column:
    """Whether up to twenty digits pass the Luhn check."""
    padded = F.lpad(digits(hit), 20, "0")
    doubled = F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)))

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(padded, place, F.lit(1)).cast("int")
        return total + F.when(place % 2 == 1, F.get(doubled, digit)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.lit(20)), F.lit(0), add) % 10 == 0


CHECKS = {
    "email": lambda hit: F.lit(True),
    "ip": lambda hit: F.forall(F.split(hit, r"\."), lambda part: part.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])$")),
    "card": luhn,
    "phone": lambda hit: F.length(digits(hit)).between(9, 15),
}


def candidates(text: Column) -> Column:
    """All proposed spans of a text, with feature bits."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    lists = []
    for number, kind in enumerate(KINDS):
        gate = text.contains(GATES[kind]) if kind in GATES else None
        lists.append(_spans(found(text, BASE[kind], gate), number, CHECKS[kind]))
        gate = text.rlike(WIDE_GATES[kind]) if kind in WIDE_GATES else None
        lists.append(_spans(found(text, WIDE[kind], gate), number, None))
    return F.concat(*lists)


def _spans(hits: Column, kind: int, check) -> Column:
    return F.transform(hits, lambda one: _span(one, kind, check is not None, F.lit(False) if check is None else check(one["hit"])))


def _span(one: Column, kind: int, base: bool, passed: Column) -> Column:
    bits = F.lit(0)
    tests = [one["before"].rlike(pattern) for _, pattern in FEATURES] + [one["hit"].rlike(pattern) for _, pattern in FORMATS]
    tests.append(F.length(digits(one["hit"])) > 11)
    for place, test in enumerate(tests):
        bits = bits + F.when(test, F.lit(1 << place)).otherwise(F.lit(0))
    named = (F.lit(kind).alias("kind"), one["start"].alias("start"), one["stop"].alias("stop"), F.lit(base).alias("base"), passed.alias("passed"), bits.alias("bits"))
    return F.struct(*named).cast(SPAN)


N_BITS = len(FEATURES) + len(FORMATS) + 1


class Trees:
    """Boosted trees over bits, one forest for each kind, with the threshold that its training cells call for."""

    def __init__(self, cells: list[tuple[int, int, bool, int]]):
        """``cells``: (kind, bits, passed, count) of the base candidates."""
        self.forests, self.thresholds, self.priors = {}, {}, {}
        for kind in {cell[0] for cell in cells}:
            own = [cell for cell in cells if cell[0] == kind]
            inputs = np.array([[bits >> place & 1 for place in range(N_BITS)] for _, bits, _, _ in own], bool)
            label = np.array([passed for _, _, passed, _ in own], float)
            weight = np.array([count for _, _, _, count in own], float)
            prior = math.log((weight @ label + 1) / (weight @ (1 - label) + 1))
            score, forest = np.full(len(own), prior), []
            for _ in range(ROUNDS):
                chance = 1 / (1 + np.exp(-score))
                tree = self._grow(inputs, weight * (label - chance), weight * chance * (1 - chance), np.ones(len(own), bool), DEPTH)
                forest.append(tree)
                score += RATE * np.array([self._leaf(tree, row) for row in inputs])
            self.priors[kind], self.forests[kind] = prior, forest
            self.thresholds[kind] = self._threshold(score, label, weight)

    @staticmethod
    def _threshold(score, label, weight) -> float:
        """The lowest score at and above which the wanted share of candidates passed; never below even odds."""
        order = np.argsort(-score, kind="stable")
        good, every = np.cumsum((label * weight)[order]), np.cumsum(weight[order])
        last = np.append(score[order][1:] < score[order][:-1], True)  # cells of one score go together
        fine = np.flatnonzero(last & (good >= PRECISION * every))
        return max(0.0, float(score[order][fine[-1]])) if len(fine) else math.inf

    def _grow(self, inputs, slope, curve, rows, depth):
        def gain(part):
            return slope[part].sum() ** 2 / (curve[part].sum() + 1.0)

        value = float(slope[rows].sum() / (curve[rows].sum() + 1.0))
        if depth == 0:
            return value
        gains = [gain(rows & inputs[:, place]) + gain(rows & ~inputs[:, place]) for place in range(N_BITS)]
        best = int(np.argmax(gains))
        if gains[best] <= gain(rows) + 1e-6:
            return value
        return (best, self._grow(inputs, slope, curve, rows & inputs[:, best], depth - 1), self._grow(inputs, slope, curve, rows & ~inputs[:, best], depth - 1))

    def _leaf(self, tree, row) -> float:
        while isinstance(tree, tuple):
            tree = tree[1] if row[tree[0]] else tree[2]
        return tree

    def _table(self, kind: int) -> dict[int, float]:
        """The forest as sums over the bits that it asks for."""
        asked = sorted(self._asked(self.forests[kind]))
        table = {}
        for case in range(1 << len(asked)):
            row = np.zeros(N_BITS, bool)
            row[[place for i, place in enumerate(asked) if case >> i & 1]] = True
            bits = sum(1 << place for i, place in enumerate(asked) if case >> i & 1)
            table[bits] = self.priors[kind] + RATE * sum(self._leaf(tree, row) for tree in self.forests[kind])
        return table

    def _asked(self, trees) -> set[int]:
        asked = set()
        for tree in trees:
            if isinstance(tree, tuple):
                asked |= {tree[0]} | self._asked(tree[1:])
        return asked

    def selected(self, span: Column) -> Column:
        """Whether the trees select a candidate. All that a forest can say is a list of bit patterns it accepts."""
        chosen = F.lit(False)
        for kind in sorted(self.forests):
            mask = sum(1 << place for place in self._asked(self.forests[kind]))
            accepted = [bits for bits, score in self._table(kind).items() if score >= self.thresholds[kind]]
            if accepted:
                chosen = chosen | ((span["kind"] == kind) & span["bits"].bitwiseAND(F.lit(mask)).isin(accepted))
        return chosen


def fit(proposed: DataFrame) -> Trees:
    """Trees from a table with candidates in ``pii_spans``. What comes to the driver is a count for each cell of bits."""
    one = proposed.select(F.explode("pii_spans").alias("s")).where("s.base")
    cells = one.groupBy("s.kind", "s.bits", "s.passed").agg(F.count("*").alias("n")).collect()
    return Trees([tuple(cell) for cell in cells])


def with_spans(df: DataFrame, text: str = "text", keep_text: bool = True) -> DataFrame:
    """``df`` with ``pii_spans``: base spans and those that the trees add, by start, then kind.

    The candidates are written once, to be counted for training and then read again for the selection.
    """
    plain = df.drop("pii_spans")
    proposed = plain.withColumn("pii_spans", candidates(F.col(text)))
    proposed = stage(proposed if keep_text else proposed.drop(text), "candidates")
    trees = fit(proposed)
    base = F.filter("pii_spans", lambda span: span["base"] & span["passed"])
    proposed = proposed.withColumn("_base", base)
    # A span of the base patterns that failed its check stays out, whatever the trees say of its surroundings.
    added = F.filter("pii_spans", lambda span: ~span["base"] & trees.selected(span) & ~F.exists("_base", lambda other: (other["start"] < span["stop"]) & (span["start"] < other["stop"])))
    every = F.concat("_base", F.transform(added, lambda span: span))
    ordered = F.transform(every, lambda span: F.struct(span["start"].alias("start"), span["kind"].alias("kind"), span["stop"].alias("stop"), span["base"].alias("base")))
    return proposed.withColumn("pii_spans", F.array_sort(F.array_distinct(ordered))).drop("_base")


def written(spans: Column) -> Column:
    """``kind:start:end``, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; of overlapping spans the first names the whole."""
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def add(done: Column, span: Column) -> Column:
        gap = F.substr(text, done["at"] + 1, span["start"] - done["at"])
        more = F.when(span["start"] >= done["at"], F.array(gap, F.get(names, span["kind"]))).otherwise(F.array().cast("array<string>"))
        return F.struct(F.greatest(done["at"], span["stop"]).alias("at"), F.concat(done["out"], more).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, zero, add, lambda done: F.concat(F.array_join(done["out"], ""), F.substr(text, done["at"] + 1, F.length(text))))
    )

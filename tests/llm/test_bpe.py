import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lotwise.llm import bpe
from tests.llm.cases import TEXTS, clashing, texts

NAME = "word_bpe_49k.json"


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(NAME))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def same(library, given):
    codec = bpe.codec_of(NAME)
    mine = codec.encode(given)
    theirs = library.encode_batch(given, add_special_tokens=False)
    for text, ids, other in zip(given, mine, theirs):
        assert ids.tolist() == other.ids, text[:80]
        assert codec.decode(ids) == library.decode(other.ids, skip_special_tokens=False)


def test_random_texts(library):
    pick = random.Random(1)
    letters = "aaabbcdestrlvm''\"  \n\t.,!?#<|>/0123é́ͅΣσßİıAZ中文ɐ𝒜‍😀\u0085 \x1c "
    given = ["".join(pick.choices(letters, k=pick.randint(0, 25))) for _ in range(4000)]
    same(library, given + [a + pick.choice(["<|startoftext|>", "<|endoftext|>", "<|ENDOFTEXT|>", "'re", "can't we'll "]) + a for a in given[:500]])


def test_words_that_the_proposal_gets_wrong(library):
    pick = random.Random(2)
    same(library, ["".join(pick.choices("ab", k=200)) for _ in range(100)] + ["a" * n for n in range(150)] + ["ha" * n for n in range(60)])


def test_given_texts(library):
    same(library, [text or "" for _, text in TEXTS])
    same(library, [])


def test_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    same(library, ["one two three four five six seven"] * 3 + ["eight nine ten one two"])


def test_pairs_are_compatible_exactly_if_merging_keeps_them():
    codec = bpe.codec_of(NAME)
    pick = np.random.default_rng(3)
    plain = [n for n, name in enumerate(codec.written[:20_000]) if name and not name.endswith("</w>")]
    a = pick.choice(plain, 1500)
    b = pick.choice(plain, 1500)
    fine = codec.compatible(a, b)
    symbols = [codec.written[x] + codec.written[y] for x, y in zip(a, b)]
    for x, y, text, ok in zip(a.tolist(), b.tolist(), symbols, fine.tolist()):
        assert (stepwise(codec, text) == [x, y]) == ok


def stepwise(codec, text):
    """The definition: always the earliest rule, leftmost first."""
    rules = {(int(codec.left[m]), int(codec.right[m])): (int(codec.rank[m]), m) for m in codec.made[1:].tolist()}
    tokens = [codec.vocab[symbol] for symbol in text]
    while True:
        found = [rules.get(pair, (1 << 40, 0)) for pair in zip(tokens, tokens[1:])]
        if not found or min(found)[0] == 1 << 40:
            return tokens
        at = found.index(min(found))
        tokens[at : at + 2] = [found[at][1]]


def test_frames(spark, library):
    rows = bpe.encode(clashing(spark), NAME).collect()
    assert len(rows) == len(TEXTS)
    for row in rows:
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(row["token_ids"], "<u4").tolist() == ids
        assert row["decoded"] == library.decode(ids, skip_special_tokens=False)
        assert row["score"] == "mine"
    assert bpe.encode(texts(spark, []), NAME).columns == ["doc_id", "text", "token_ids", "decoded"]
    assert bpe.encode(texts(spark, []), NAME).count() == 0

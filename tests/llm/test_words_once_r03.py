"""Round 3: a word is looked up once for all texts that are encoded together, however few words are remembered."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from siftloom.llm.words import FastTokenizer


class Counting:
    def __init__(self, model):
        self.model, self.seen = model, []

    def tokenize(self, text):
        self.seen.append(text)
        return self.model.tokenize(text)


def test_each_word_goes_to_the_model_once():
    path = public_tokenizers.path("byte_bpe_50k.json")
    fast, plain = FastTokenizer(path, "<u2", 2), Tokenizer.from_file(path)
    fast.model = Counting(fast.model)
    texts = ["alphabeta gammadelta épsilon zetaeta", "gammadelta zetaeta alphabeta épsilon"] * 3
    got = fast.encode(texts)
    assert len(fast.model.seen) == len(set(fast.model.seen)) == 6  # two of the words also begin a text, without a space
    assert [len(x) // 2 for x in got] == [len(plain.encode(t, add_special_tokens=False).ids) for t in texts]
    assert got[0] == b"".join(i.to_bytes(2, "little") for i in plain.encode(texts[0], add_special_tokens=False).ids)


@pytest.mark.parametrize("blank", ["\x1c", "\x85", "\xa0", " ", " ", " ", " ", " ", "　", "\t", "\r", "\v", "​", "\xad", "﻿", "\x00"])
def test_other_white_space_and_odd_letters(blank):
    path = public_tokenizers.path("byte_bpe_50k.json")
    fast, plain = FastTokenizer(path, "<u4", 3), Tokenizer.from_file(path)
    texts = ["", f"a{blank}b", f"a {blank} b", f"{blank}a\nb", f"a\nb{blank}", blank, f"x, y.\n{blank}z", "ÿ ÿ, İ", "a<|b", "one two\nthree, four.", "l'été à Paris.\nÀ-vous, oui!"]
    assert fast.encode(texts) == [b"".join(i.to_bytes(4, "little") for i in plain.encode(t, add_special_tokens=False).ids) for t in texts]

"""Public tokenizers applied word by word, each distinct word once while it is remembered."""

from __future__ import annotations

import gc
import os
import re
import string
from codecs import charmap_decode
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words that a worker remembers; the memory starts afresh beyond it.
REMEMBERED = 300_000
#: Longest word, with its punctuation, that is remembered.
LONGEST = 64

#: Separators that Python takes for white space and the tokenizers don't.
_SEPARATORS = re.compile("[\x1c-\x1f]")
_SPECIAL = "<|"
#: What bars cutting a text into words at its single spaces and line ends, for vocabularies that keep the space: special tokens, other white
#: space, two spaces or line ends in a row, one at the text's beginning or end, no text.
_UNEVEN = (
    r"<\||[\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]|\A[ \n]|[ \n]\z|\A\z"
)
#: Letters that normal form C leaves alone and that have one lower case each, wherever they stand.
_PLAIN = re.compile("[A-Za-zÀ-ÖØ-öø-į]+").fullmatch
_MARKS = string.punctuation


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for themselves, others for letters from 256 on, in order."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


class _Known(dict):
    """Ids of words or parts of words, as bytes; one that isn't known is learned."""

    def __init__(self, learn: Callable[[str], bytes], remembered: int) -> None:
        super().__init__()
        self.learn, self.remembered = learn, remembered

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.remembered:
            self.clear()
        ids = self.learn(word)
        if len(word) <= LONGEST:
            self[word] = ids
        return ids


class FastTokenizer:
    """The ids of ``tokenizers`` for whole texts, as bytes of little-endian numbers of ``width``.

    Both kinds of vocabulary cut texts at white space before anything else, and at a word's end before its
    punctuation, so a text's ids are its words' ids in a row. Words of plain letters go to the vocabulary's
    model alone; other words, and texts in which a cut could fall elsewhere or that may hold special tokens,
    go through the whole tokenizer.
    """

    def __init__(self, path: str, width: str = "<u4", remembered: int = REMEMBERED) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallel parts
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.width, self.letters = self.tokenizer.model, width, _byte_letters()
        self.table = "".join(self.letters[b] for b in range(256))
        ids = np.arange(self.tokenizer.get_vocab_size(with_added_tokens=True)).astype(width)
        if int(ids[-1]) != len(ids) - 1:
            raise ValueError(f"ids of this vocabulary don't fit {width}")
        #: Bytes of each id.
        self.number = [i.tobytes() for i in ids]
        #: Byte-level vocabularies keep the space before a word as part of it; the others have no upper case.
        self.keeps_space = self.tokenizer.normalizer is None
        self.space = self.letters[32] if self.keeps_space else ""
        self.newline = self.whole("\n")
        #: Ids of words as they stand between white space (those that begin a line with the line's end).
        self.known = _Known(self.word, remembered)
        #: Ids of stems and of punctuation, as the model takes them.
        self.parts = _Known(self.part, remembered)

    def whole(self, text: str) -> bytes:
        return self.as_bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def as_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.number[i] for i in ids])

    def part(self, text: str) -> bytes:
        number = self.number
        return b"".join([number[t.id] for t in self.model.tokenize(text)])

    def word(self, word: str) -> bytes:
        """Ids of a word between white space; one that begins a line has the line's end before it."""
        if word[0] == "\n":
            return self.newline + self.bare(word[1:], "")
        return self.bare(word, self.space)

    def bare(self, word: str, space: str) -> bytes:
        stem = word.rstrip(_MARKS)
        ascii_letters = stem.isascii() and stem.isalpha()
        if not ascii_letters and not _PLAIN(stem):
            return self.whole(" " + word if space else word)
        ids = stem if self.keeps_space else stem.lower()
        if not ascii_letters and not ids.isascii():
            ids = ids.encode().decode("latin-1").translate(self.letters)
        if len(stem) == len(word):  # the word itself is remembered, so its stem needn't be
            return self.parts.get(space + ids) or self.part(space + ids)
        return self.parts[space + ids] + self.parts[word[len(stem) :]]

    def learn(self, words: list[str]) -> list[bytes]:
        """Ids of each of these different words of a vocabulary that keeps the space."""
        out, tokenize, number, space, known = [], self.model.tokenize, self.number, self.space, self.known
        for word in words:
            if word.isascii() and word.isalpha():
                out.append(b"".join([number[t.id] for t in tokenize(space + word)]))
                continue
            line = word[0] == "\n"
            bare = word[1:] if line else word
            stem = bare.rstrip(_MARKS)
            ids = None if line or len(stem) == len(bare) else known.get(stem)
            if ids is None:
                if not _PLAIN(stem):
                    out.append(self.word(word))
                    continue
                letters = stem if stem.isascii() else charmap_decode(stem.encode(), "strict", self.table)[0]
                letters = letters if line else space + letters
                # a word without punctuation is remembered itself, so its stem needn't be
                ids = self.part(letters) if len(stem) == len(bare) else self.parts[letters]
            marks = bare[len(stem) :]
            out.append((self.newline if line else b"") + ids + (self.parts[marks] if marks else b""))
        return out

    def lookup(self, words: list[str]) -> list[bytes]:
        """Ids of each of these different words; those that aren't remembered are learned, each once."""
        out = list(map(self.known.get, words))
        places = [i for i, ids in enumerate(out) if ids is None]
        new = [words[i] for i in places]
        if len(self.known) + len(new) > self.known.remembered:
            self.known.clear()
        for i, word, ids in zip(places, new, self.learn(new), strict=True):
            out[i] = ids
            if len(word) <= LONGEST and len(self.known) < self.known.remembered:
                self.known[word] = ids
        return out

    def encode_lines(self, lines: pa.Array) -> list[bytes]:
        """Ids of texts that _UNEVEN doesn't match, given with a line's end first and a space before their other line ends.

        Arrow cuts them into words and numbers the different ones, so that each is looked up once for all of these texts.
        """
        cut = pc.split_pattern(lines, " ")
        words = cut.flatten().dictionary_encode()
        known = self.lookup(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        width = np.dtype(self.width).itemsize
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // width
        ids, starts, codes = np.frombuffer(b"".join(known), dtype=self.width), np.cumsum(sizes) - sizes, words.indices.to_numpy()
        each = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(each)])
        flat = ids[np.arange(ends[-1]) + np.repeat(starts[codes] - ends[:-1], each)].tobytes()
        # the line's end before the first word is none of the text's
        first, bounds = len(self.newline), (ends[cut.offsets.to_numpy()] * width).tolist()
        return [flat[a + first : b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        if not self.keeps_space:
            get = self.known.__getitem__
            return [self.whole(x) if _SPECIAL in x or _SEPARATORS.search(x) else b"".join(map(get, x.split())) for x in texts]
        array = pa.array(texts, pa.large_string())
        uneven = pc.match_substring_regex(array, _UNEVEN)
        even = pc.replace_substring(array.filter(pc.invert(uneven)), "\n", " \n")
        line_end, nothing = pa.scalar("\n", even.type), pa.scalar("", even.type)
        cut = iter(self.encode_lines(pc.binary_join_element_wise(line_end, even, nothing)))
        return [self.whole(x) if odd else next(cut) for x, odd in zip(texts, uneven.to_pylist(), strict=True)]


_kept: dict[tuple[str, str, int], FastTokenizer] = {}


def fast_tokenizer(path: str, width: str = "<u4", remembered: int = REMEMBERED) -> FastTokenizer:
    """One of each kind in a Python worker."""
    if (path, width, remembered) not in _kept:
        _kept[path, width, remembered] = FastTokenizer(path, width, remembered)
        gc.freeze()  # the vocabulary and the memory hold no cycles, so that collections needn't go through them
    return _kept[path, width, remembered]

"""Token ids by the tokenizers library, one call per distinct word.

A text's ids are the ids of its words in order, as long as words are cut where the
tokenizer itself always cuts. Natural text repeats its words, so every worker keeps
the ids of those it has met of late.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterable

import numpy as np

#: Words of a generation (about 200 bytes each), of which a worker remembers two.
GENERATION = 450_000
SIGNS = 20_000  # runs of punctuation a worker remembers
MET = 1 << 25  # bits for words that have been met once
CLOSING = frozenset(",.;:!?")  # signs that are looked up apart from the word before them

# Letters that are their own canonical composition, then plain punctuation. The
# apostrophe is left out because tokenizers treat some words after it apart.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_BEFORE_WORD = re.compile(r"(?= \S)")
_UNEVEN_SPACE = re.compile(r" (?=\s|$)")
_UNEVEN_BREAK = re.compile(r"\n(?=\s|\Z)")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next free one from U+0100."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {b: chr(0x100 + k) for k, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()
#: What the bytes of the first 256 code points are written as; plain words have no others.
_WRITTEN = {c: c.encode().decode("latin-1").translate(_BYTE_LETTERS) for c in map(chr, range(256))}


def written(part: str) -> str:
    """How byte-level vocabularies write a part of the first 256 code points."""
    return "".join(map(_WRITTEN.__getitem__, part))


class WordIds(dict):
    """Ids of words, and of whole texts, for one vocabulary file; a new word is looked up once.

    ``spaces`` says whether the vocabulary keeps a space as the first sign of the
    word after it (byte-level files) or drops white space and case (word files).
    Special tokens' names in a text are ordinary text. Words are kept as they stand
    between spaces, without the space; a word that neither this generation (the dictionary
    itself) nor the one before has met is forgotten. Most words of a text come once: a
    word is only kept when it, or one with the same bit in ``met``, comes again.
    """

    def __init__(self, path: str, spaces: bool) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.tokenize = self.tokenizer.model.tokenize
        self.spaces = spaces
        self.before = _BYTE_LETTERS[0x20] if spaces else ""
        self.old: dict[str, bytes] = {}
        self.met = bytearray(MET >> 3)
        self.signs: dict[str, bytes] = {}

    def _part(self, part: str) -> bytes:
        """Ids of letters, with the space before them, or of punctuation, straight from the merges."""
        return self._shown(written(part))

    def _shown(self, part: str) -> bytes:
        """Ids of a part whose bytes are written as letters."""
        return array("I", [token.id for token in self.tokenize(part)]).tobytes()

    def _sign(self, signs: str) -> bytes:
        ids = self.signs.get(signs)
        if ids is None:
            if len(self.signs) > SIGNS:
                self.signs.clear()
            ids = self.signs[signs] = self._part(signs)
        return ids

    def _whole(self, text: str) -> bytes:
        found = self.tokenizer.encode(text, add_special_tokens=False)
        return array("I", found.ids).tobytes()

    def _new(self, word: str) -> bytes:
        """Ids of a word (after a space, if the vocabulary keeps it).

        Letters and punctuation are looked up apart, single line breaks may join such words;
        all else goes through the tokenizer as a whole.
        """
        space = " " if self.spaces else ""
        if found := _SIMPLE.fullmatch(word):
            letters, signs = found.groups()
            if not self.spaces:
                letters = letters.lower()
            if letters == word:
                return self._part(space + letters)
            return self[letters] + self._sign(signs) if signs else self[letters]
        out = []
        for k, piece in enumerate(word.split("\n")):
            found = _SIMPLE.fullmatch(piece)
            if not found:
                return self._whole(space + word)
            letters, signs = found.groups()
            if not self.spaces:
                letters = letters.lower()
            if k and self.spaces:
                out.append(self._sign("\n") + self._part(letters))
            elif letters == word:
                out.append(self._part(space + letters))
            else:
                out.append(self[letters])
            if signs:
                out.append(self._sign(signs))
        return b"".join(out)

    def _after_break(self, word: str) -> bytes:
        """Ids of a line break and the word right after it, without a space between them."""
        found = _SIMPLE.fullmatch(word, 1)
        if not found:
            return self._whole(word)
        letters, signs = found.groups()
        ids = self._sign("\n") + self._part(letters)
        return ids + self._sign(signs) if signs else ids

    def __missing__(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            if word.isascii() and word.isalpha():
                shown = self.before + (word if self.spaces else word.lower())
                ids = array("I", [token.id for token in self.tokenize(shown)]).tobytes()
            elif word[-1:] in CLOSING and word[:-1].isalpha() and word.isascii():
                ids = self[word[:-1]] + self._sign(word[-1])
            elif self.spaces and word[0] == "\n":
                ids = self._after_break(word)
            else:
                ids = self._new(word)
            place = hash(word) & MET - 1
            if not self.met[place >> 3] >> (place & 7) & 1:
                self.met[place >> 3] |= 1 << (place & 7)
                return ids
        self[word] = ids
        return ids

    def _ids(self, text: str) -> bytes:
        if not self.spaces:
            words = (text.lower() if text.isascii() else text).split(" ")
            return b"".join(map(self.__getitem__, words))
        if _UNEVEN_SPACE.search(text):
            # Runs of white space: cut only before a space that a word follows at once.
            first, *rest = _BEFORE_WORD.split(text)
            words = [word[1:] for word in rest]
        else:
            if not _UNEVEN_BREAK.search(text):
                # A line break between words is cut on both sides. Here no other space comes before one.
                text = text.replace("\n", " \n")
            first, *words = text.split(" ")
        found = _SIMPLE.fullmatch(first)
        if not found:
            return self._whole(first) + b"".join(map(self.__getitem__, words))
        letters, signs = found.groups()
        begin = self._part(letters) + (self._sign(signs) if signs else b"")
        return begin + b"".join(map(self.__getitem__, words))

    def encode(self, texts: Iterable[str | None], end_id: int) -> list[np.ndarray]:
        """One array of ids per text, each closed by ``end_id``; a null text has only that."""
        end = np.array([end_id], dtype="<u4").tobytes()
        out = []
        for text in texts:
            out.append(np.frombuffer((self._ids(text) if text else b"") + end, dtype="<u4"))
            if len(self) > GENERATION:
                self.old = dict(self)
                self.clear()
                self.met = bytearray(MET >> 3)
        return out


@functools.lru_cache(maxsize=4)
def word_ids(path: str, spaces: bool) -> WordIds:
    """The worker's encoder of a vocabulary file, with what it remembers."""
    return WordIds(path, spaces)

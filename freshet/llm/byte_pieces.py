"""Token ids of whole columns by a byte-level vocabulary: one look-up per distinct piece.

Texts are cut in numpy wherever the tokenizer's own pattern always cuts, Arrow numbers
the distinct pieces of a slice, and only those are looked up one by one; the ids of all
texts are then gathered at once. A worker keeps the ids of pieces it has met of late.

The pattern takes contractions, letters, digits or other signs, each run with the space
before it, and white space. It never looks back, so what follows a cut does not depend on
what is before it. Where a cut is not certain none is made, and the tokenizer gets the
longer piece.
"""

from __future__ import annotations

import functools
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from freshet.llm.tokens import GENERATION, MET, written

SLICE_BYTES = 4 << 20  # of text that is cut and numbered at once
KEPT = 64  # letters of the longest piece that is remembered

# Kinds of bytes. Apostrophes may begin a contraction and are OTHER, as are all beyond ASCII
# but the letters À to ÿ.
OTHER, LETTER, SIGN, DIGIT, SPACE, BREAK, BLANK, WIDE = range(8)
_WIDE_LEADS = b"\xc2\xe1\xe2\xe3"  # white space beyond ASCII begins with one of these
_SIGNS = "!-&(-/:-@\\[-`{-~"
_RUN = re.compile(rf" ?(?:[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]+|[{_SIGNS}]+)|\n")


def _kinds() -> np.ndarray:
    kinds = np.full(256, OTHER, dtype=np.uint8)
    for b in range(128):
        c = chr(b)
        if c.isalpha():
            kinds[b] = LETTER
        elif c.isdigit():
            kinds[b] = DIGIT
        elif c.isspace():
            kinds[b] = {" ": SPACE, "\n": BREAK}.get(c, BLANK)
        elif re.fullmatch(f"[{_SIGNS}]", c):
            kinds[b] = SIGN
    kinds[list(_WIDE_LEADS)] = WIDE
    return kinds


def _cuts() -> np.ndarray:
    """Whether a piece begins between two such bytes; ``pieces`` adds cuts at white space."""
    runs, white = {LETTER, SIGN, DIGIT}, {SPACE, BREAK, BLANK}
    cuts = np.zeros((8, 8), dtype=bool)
    for a in range(8):
        for b in range(8):
            if {a, b} <= runs:
                cuts[a, b] = a != b
            elif b == BREAK:
                cuts[a, b] = a not in white
            elif a == BREAK:
                cuts[a, b] = b not in white
    return cuts.ravel()


_KINDS, _CUTS = _kinds(), _cuts()


def rows_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column, and where each row begins in them, then the end."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, places, data = column.buffers()
    if not len(column):
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    at = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def column_of(data: np.ndarray, begins: np.ndarray) -> pa.Array:
    """A binary column of such bytes."""
    places = pa.py_buffer(begins.astype(np.int32))
    data = pa.py_buffer(np.ascontiguousarray(data))
    return pa.Array.from_buffers(pa.binary(), len(begins) - 1, [None, places, data])


def slices(begins: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most so many bytes together, or of one row."""
    at = 0
    while at < len(begins) - 1:
        to = int(np.searchsorted(begins, begins[at] + most, side="right")) - 1
        to = max(to, at + 1)
        yield at, to
        at = to


def pieces(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts of UTF-8 that lie one after the other."""
    kinds = _KINDS[data]
    wide = np.flatnonzero(kinds == WIDE)
    if len(wide):
        # Marks the white space beyond ASCII, generously: without it a cut is certain.
        padded = np.concatenate([data, np.zeros(2, dtype=np.uint8)])
        lead, second, third = padded[wide], padded[wide + 1], padded[wide + 2]
        kinds[wide] = OTHER
        two = (lead == 0xC2) & ((second == 0x85) | (second == 0xA0))
        three = (lead == 0xE1) & ((second == 0x9A) | (second == 0xA0))
        three |= (lead == 0xE2) & (second == 0x80) & ((third < 0x90) | (third >= 0xA8))
        three |= (lead == 0xE2) & (second == 0x81)
        three |= (lead == 0xE3) & (second == 0x80)
        for k in range(2):
            kinds[wide[two] + k] = BLANK
        for k in range(3):
            kinds[wide[three] + k] = BLANK
    latin = np.flatnonzero(data == 0xC3)
    if len(latin):
        second = data[latin + 1]
        latin = latin[(second != 0x97) & (second != 0xB7)]  # times and divided-by
        kinds[latin] = LETTER
        kinds[latin + 1] = LETTER
    starts = np.zeros(len(data), dtype=bool)
    starts[1:] = _CUTS[kinds[:-1] << 3 | kinds[1:]]
    # Before something else than white space, a space goes with that and a break stands alone.
    full = begins[:-1] < begins[1:]
    after = np.append(kinds[1:], np.uint8(BLANK))
    after[begins[1:][full] - 1] = BLANK
    last = np.flatnonzero((kinds == SPACE) | (kinds == BREAK))
    after = after[last]
    starts[last[(after < SPACE) | (after > BLANK)]] = True
    starts[begins[:-1][full]] = True
    return np.flatnonzero(starts)


class PieceIds:
    """Ids of pieces, and of columns of texts, for one byte-level vocabulary file.

    Special tokens' names in a text are ordinary text. A piece that neither this
    generation (``known``) nor the one before has met is forgotten; it is only kept when
    it, or one with the same bit in ``met``, comes in a second slice.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.met = np.zeros(MET >> 3, dtype=np.uint8)

    def _look_up(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces, straight from the merges if they are one run."""
        tokenize, space = self.tokenizer.model.tokenize, written(" ")
        found = []
        for piece in pieces:
            if piece[0] == " " and piece.isascii() and piece[1:].isalpha():
                ids = [token.id for token in tokenize(space + piece[1:])]
            elif _RUN.fullmatch(piece):
                ids = [token.id for token in tokenize(written(piece))]
            else:
                ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
            found.append(array("I", ids).tobytes())
        return found

    def _met_before(self, pieces: list[str]) -> np.ndarray:
        """Which of some distinct pieces have come in an earlier slice; now all have."""
        place = np.fromiter(map(hash, pieces), dtype=np.int64, count=len(pieces)) & MET - 1
        bit = (1 << (place & 7)).astype(np.uint8)
        met = self.met[place >> 3] & bit != 0
        np.bitwise_or.at(self.met, place >> 3, bit)
        return met

    def of(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces."""
        known = self.known
        found = list(map(known.get, pieces))
        new = [k for k, ids in enumerate(found) if ids is None]
        if self.old:
            unknown = []
            for k in new:
                if (ids := self.old.get(pieces[k])) is None:
                    unknown.append(k)
                else:
                    found[k] = known[pieces[k]] = ids
            new = unknown
        names = [pieces[k] for k in new]
        kept = self._met_before(names).tolist()
        for k, piece, ids, keep in zip(new, names, self._look_up(names), kept, strict=True):
            found[k] = ids
            if keep and len(piece) <= KEPT:
                known[piece] = ids
        if len(known) > GENERATION:
            self.old, self.known = known, {}
            self.met[:] = 0
        return found

    def encode(
        self, data: np.ndarray, begins: np.ndarray, end_id: int, kind: str = "<u4"
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, each closed by ``end_id``, and where each text's begin, then the end.

        The texts lie one after the other in ``data``, as ``rows_of`` gives them.
        """
        starts = pieces(data, begins)
        places = pa.py_buffer(np.append(starts, len(data)))
        found = pa.Array.from_buffers(
            pa.large_string(), len(starts), [None, places, pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        known = self.of(found.dictionary.to_numpy(zero_copy_only=False).tolist())
        known.append(array("I", [end_id]).tobytes())
        ids = np.frombuffer(b"".join(known), dtype="<u4").astype(kind)
        length = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) >> 2
        first = np.cumsum(length) - length
        # The end id is the last piece of every text.
        last = np.searchsorted(starts, begins[1:])
        numbers = np.insert(found.indices.to_numpy(), last, len(known) - 1)
        length = length[numbers]
        stop = np.cumsum(length)
        from_place = np.repeat(first[numbers] - stop + length, length)
        from_place += np.arange(len(from_place))
        return ids[from_place], np.append(0, stop[last + np.arange(len(last))])


@functools.lru_cache(maxsize=4)
def piece_ids(path: str) -> PieceIds:
    """The worker's encoder of a byte-level vocabulary file, with what it remembers."""
    return PieceIds(path)

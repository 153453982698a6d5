"""Byte-level BPE encoding in executors, a column of texts at a time, with a bounded cache of pieces.

Texts are cut, on their bytes, where the pre-tokeniser surely starts a new piece: at a space before a non-space, and in
ASCII where letters, digits, signs and white space meet. So a text's pieces, encoded one by one, give the ids of the whole
text. Most pieces recur: Arrow numbers a batch's distinct pieces, a worker keeps the ids of those it has met lately, and the
ids of all pieces are put together by number. A new piece is split by the tokenizer's own pattern, and what the pattern
finds goes straight to the model.
"""

from __future__ import annotations

import os
from array import array

import numpy as np
import pyarrow as pa

from citeloom.llm.textops import KEPT, bytes_of

END_ID = 0
#: How byte-level BPE writes a leading space.
SPACE_LETTER = chr(256 + 0x20)

_OTHER, _LETTER, _DIGIT, _SIGN, _QUOTE, _WHITE, _BLANK = range(7)
#: The kind of each byte. Controls and bytes above ASCII are of no kind of which anything is known.
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = _SIGN
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
_KIND[0x30:0x3A], _KIND[0x27], _KIND[0x09:0x0E], _KIND[0x20] = _DIGIT, _QUOTE, _WHITE, _BLANK
#: Second bytes of the letters from U+00C0 to U+00FF, all but the signs of multiplication and division.
_LATIN = np.zeros(256, bool)
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False
#: Whether a piece always ends between bytes of two kinds, as ``8 * first + second``. A blank goes with what follows it, a
#: quote with letters ('s); white space looks ahead, so it is left to ``piece_starts``.
_BETWEEN = np.zeros(64, bool)
for _a in (_LETTER, _DIGIT, _SIGN, _QUOTE):
    for _b in (_LETTER, _DIGIT, _SIGN, _QUOTE, _WHITE, _BLANK):
        _BETWEEN[8 * _a + _b] = _a != _b and (_a, _b) not in ((_QUOTE, _LETTER), (_QUOTE, _SIGN), (_SIGN, _QUOTE))
_SOLID = np.isin(np.arange(8), (_LETTER, _DIGIT, _SIGN, _QUOTE))


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letters byte-level BPE writes bytes as: printable Latin-1 stands for itself, the others follow from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    odd = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(odd)}


def _before_white(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that begins at each of ``at`` is white space (or one of the controls 0x1C to 0x1F)."""
    a, b, c = (np.append(data, [0, 0, 0])[at + i].astype(np.int32) for i in range(3))
    three = a << 16 | b << 8 | c
    white = (a == 0x20) | (a >= 0x09) & (a <= 0x0D) | (a >= 0x1C) & (a <= 0x1F) | (a == 0xC2) & ((b == 0x85) | (b == 0xA0))
    return white | (three >= 0xE28080) & (three <= 0xE2808A) | np.isin(three, (0xE19A80, 0xE280A8, 0xE280A9, 0xE280AF, 0xE2819F, 0xE38080))


def piece_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """First bytes of the pieces of texts that lie at ``off`` in ``data``; each text that is not empty begins one."""
    if not len(data):
        return np.zeros(0, np.int64)
    kind, edge = _KIND[data], np.zeros(len(data) + 1, bool)
    edge[off] = True
    two = np.flatnonzero(data[:-1] == 0xC3)
    two = two[_LATIN[data[two + 1]]]
    kind[two] = kind[two + 1] = _LETTER
    cut = edge[:-1].copy()
    cut[1:] |= _BETWEEN[kind[:-1] << 3 | kind[1:]]
    # one white space between two others is a piece, more of them may be divided
    white = np.flatnonzero(kind[1:-1] == _WHITE) + 1
    cut[white[~edge[white] & _SOLID[kind[white - 1]] & _SOLID[kind[white + 1]]] + 1] = True
    blank = np.flatnonzero((kind[:-1] == _BLANK) & ~cut[:-1])
    cut[blank[~edge[blank + 1] & ~_before_white(data, blank + 1)]] = True
    return np.flatnonzero(cut)


class PieceEncoder(dict):
    """Maps a piece to its ids as unsigned 32-bit integers in the machine's order (little-endian).

    Once ``most`` pieces are held they become the older ones, and those they follow are forgotten, save what is met again.
    """

    def __init__(self, path: str, most: int):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.most, self.older, self.bare = Tokenizer.from_file(path), most, {}, {}
        self.model, self.letters = self.tokenizer.model, _byte_letters()
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.letter_run = regex.compile(r" ?\p{L}+")

    @classmethod
    def get_one(cls, path: str, most: int = 500_000) -> PieceEncoder:
        """One per worker process, kept between tasks, until one of another kind wants its memory."""
        key = cls, path, most
        if key not in KEPT:
            KEPT.clear()
            KEPT[key] = cls(path, most)
        return KEPT[key]

    def word(self, word: str) -> bytes:
        """Ids of one pre-token, its bytes written as letters."""
        return array("I", [t.id for t in self.model.tokenize(word)]).tobytes()

    def spelled(self, part: str) -> bytes:
        """Ids of one pre-token."""
        if part.isascii() and part.isalpha():
            return self.word(part)
        return self.word(part.encode().decode("latin-1").translate(self.letters))

    def direct(self, text: str) -> bytes:
        """Ids by the tokenizer's pattern; special tokens' names are ordinary text."""
        out, bare = [], self.bare
        for part in self.pattern.findall(text):
            found = bare.get(part)
            if found is None:
                found = self.spelled(part)
                if len(part) <= 64:
                    if len(bare) >= self.most // 4:
                        bare.clear()
                    bare[part] = found
            out.append(found)
        return b"".join(out)

    def __missing__(self, piece: str) -> bytes:
        found = self.older.get(piece)
        if found is not None:
            pass
        elif piece[0] == " " and (rest := piece[1:]).isalpha():
            found = self.word(SPACE_LETTER + rest) if rest.isascii() else self.spelled(piece)
        elif piece.isalpha():
            found = self.spelled(piece)
        elif (run := self.letter_run.match(piece)) and run.end() < len(piece):
            # the pattern takes a space and all letters after it first, and looks back at nothing
            found = self[run[0]] + self.direct(piece[run.end() :])
        else:
            found = self.direct(piece)
        if len(piece) <= 64:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[piece] = found
        return found

    def encode_column(self, texts: pa.Array, after: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of the whole texts, each followed by the ids ``after``; a null or empty text has no others."""
        data, off = bytes_of(texts)
        starts = piece_starts(data, off)
        first = np.searchsorted(starts, off)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int32)), pa.py_buffer(data)).dictionary_encode()
        coded = list(map(self.__getitem__, pieces.dictionary.to_numpy(zero_copy_only=False).tolist()))
        order = np.insert(pieces.indices.to_numpy(), first[1:], len(coded))
        # wide offsets, as four bytes an id may be more than a text's own
        found = pa.array([*coded, after], pa.large_binary()).take(pa.array(order))
        ends = np.frombuffer(found.buffers()[1], np.int64, len(order) + 1)[first + np.arange(len(first))] // 4
        return np.frombuffer(found.buffers()[2] or b"", "<i4", ends[-1]), ends

    def encode(self, text: str | None) -> bytes:
        """The ids of the whole text; none for null or empty."""
        return self.encode_column(pa.array([text], pa.string()))[0].tobytes()

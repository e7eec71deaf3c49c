"""Whole-text tokenisation inside tasks.

Both public vocabularies split a text at a single space between two visible
characters whatever surrounds it, so a text's ids are the ids of its
space-separated pieces in order.  Pieces repeat far more often than texts do:
each worker keeps a bounded table piece -> ids, of two generations, and gives
only new pieces to the tokenizers library.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import pyarrow as pa

CACHE = 250_000  # pieces of a generation unless the caller says otherwise; a worker remembers two
LONGEST = 64  # longer pieces are encoded but not remembered

# Runs that both vocabularies take as units wherever they stand: Latin-1
# letters, and ASCII punctuation but the apostrophe.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARK = re.escape("".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"))
_SAFE = re.compile(r"(?<=\S)(?= \S)")
_WORD = re.compile(f"[{_LETTER}]+").fullmatch
_SIMPLE = re.compile(f"(?:[{_LETTER}]++|[{_MARK}]++|(?<!^)\n(?=[{_LETTER}{_MARK}]))+").fullmatch
_UNITS = re.compile(f"[{_LETTER}]+|[{_MARK}]+|\n").findall


def _unclean(piece: str) -> bool:
    """The space before or after the piece may not be a place to split at."""
    return not piece or piece[0].isspace() or piece[-1].isspace()


class _Unclean(Exception):
    """A piece at whose ends the text may not be split."""


class _Table(dict):
    """Ids of pieces.  A full table becomes the older generation; pieces found
    there move on, so what is in use stays."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.encode(piece)
            if len(piece) > LONGEST:
                return ids
        if len(self) >= self.most:
            self.older.clear()  # first, so that no more than two generations are held
            self.older.update(self)
            self.clear()
        self[piece] = ids
        return ids


class Encoder:
    """Ids of whole texts, as the bytes of little-endian int32."""

    def __init__(self, path: str, cache: int | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        # texts are cut at the strings of added tokens first, as the library does
        self.tokenizer.encode_special_tokens = True
        self.added = {t.content: array("i", [i]).tobytes() for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.cut = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})").split
        self.model = self.tokenizer.model
        # how the model sees a space before a unit, each letter, and a line end
        self.lead = self._seen(" a")[:-1]
        letters = [chr(c) for c in range(256) if _WORD(chr(c))]
        self.form = {ord(c): self._seen(c) for c in letters}
        # ASCII letters come as they are or in lower case: quicker than a table
        self.ascii = next((f for f in (str, str.lower) if all(f(c) == self.form[ord(c)] for c in letters if c < "\x80")), None)
        self.line_end = self._seen("\n")
        self.known = _Table(self._spaced, cache or CACHE)  # pieces after a space
        # words after something else
        self.opening = _Table(lambda unit: self._model(self._formed(unit)), cache or CACHE)
        self.marks: dict[str, bytes] = {}

    def _seen(self, text: str) -> str:
        norm, pre = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        return "".join(x for x, _ in pre.pre_tokenize_str(norm.normalize_str(text) if norm else text))

    def _formed(self, word: str) -> str:
        return self.ascii(word) if self.ascii and word.isascii() else word.translate(self.form)

    def _model(self, seen: str) -> bytes:
        return array("i", [t.id for t in self.model.tokenize(seen)]).tobytes()

    def _unit(self, unit: str, spaced: bool) -> bytes:
        """Ids of a run of letters or marks, or of one line end."""
        if unit == "\n":
            return self._model(self.line_end) if self.line_end else b""
        if unit[0].isalpha():
            return self.known[unit] if spaced else self.opening[unit]
        lead = self.lead if spaced else ""
        known = self.marks.get(lead + unit)
        if known is None:
            known = self._model(lead + unit)
            if len(unit) <= 4:  # at most 31^4 of them, and few in any text
                self.marks[lead + unit] = known
        return known

    def _spaced(self, piece: str) -> bytes:
        if _WORD(piece):
            return self._model(self.lead + self._formed(piece))
        if _unclean(piece):
            raise _Unclean
        return self._ids(piece, True)

    def _ids(self, piece: str, spaced: bool) -> bytes:
        """Ids of a piece, after a space if ``spaced``."""
        if _WORD(piece):
            return self._model((self.lead if spaced else "") + self._formed(piece))
        if _SIMPLE(piece):
            head, *tail = _UNITS(piece)
            return self._unit(head, spaced) + b"".join([self._unit(u, False) for u in tail])
        got = self.tokenizer.encode([" " + piece if spaced else piece], is_pretokenized=True, add_special_tokens=False)
        return array("i", got.ids).tobytes()

    def _ordinary(self, text: str) -> bytes:
        """Ids of a text without added tokens."""
        head, *rest = text.split(" ")
        if not _unclean(head):
            try:
                return self._ids(head, False) + b"".join(map(self.known.__getitem__, rest))
            except _Unclean:
                pass
        head, *rest = _SAFE.split(text)
        rest = [p[1:] for p in rest]
        return self._ids(head, False) + b"".join([self._ids(p, True) if _unclean(p) else self.known[p] for p in rest])

    def _encode(self, text: str) -> bytes:
        if not any(a in text for a in self.added):
            return self._ordinary(text)
        parts = self.cut(text)  # each second one is added
        return b"".join([self.added[s] if k % 2 else self._ordinary(s) for k, s in enumerate(parts)])

    def encode(self, texts: Iterator[str | None]) -> Iterator[bytes]:
        """One value for each text in order; null is encoded as the empty text."""
        return (self._encode(t or "") for t in texts)


def strings(column: pa.Array, rows: int = 256) -> Iterator[str | None]:
    """Values of a string column, few at a time."""
    for at in range(0, len(column), rows):
        yield from column.slice(at, rows).to_pylist()


_ENCODERS: dict[tuple[str, int | None], Encoder] = {}


def encoder(path: str, cache: int | None = None) -> Encoder:
    """The worker's encoder of a vocabulary file, loaded once."""
    if (path, cache) not in _ENCODERS:
        _ENCODERS[path, cache] = Encoder(path, cache)
    return _ENCODERS[path, cache]

"""Token ids of whole texts with a public tokenizer file, encoding each distinct piece once per worker.

Between two characters that are not white space, a single space always ends a pre-token in the
tokenizers used here (byte-level and word-end BPE), so a text may be cut before such spaces and
the ids of its pieces joined.  Pieces repeat, and a worker keeps the ids it has found; the
store is emptied when full, which changes no result.  Texts where a piece starts or ends with
white space, or holds the string of an added token, are encoded as a whole.
"""

from __future__ import annotations

import json
import os
import sys
from array import array
from functools import lru_cache

import numpy as np
import regex

#: Pieces remembered per worker; about 200 bytes each.
REMEMBERED = 1_200_000


# How byte-level tokenizers cut text into pre-tokens unless their file has a pattern
# of its own, and the characters they write for bytes (printable ones stand for themselves).
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARACTERS = {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_PRINTABLE}))}
#: Below this character, pattern and lower case mean the same to the tokenizer and to Python.
_PLAIN = "\u0250"


class TextEncoder:
    """``encode(text)`` gives the ids as little-endian bytes of ``dtype``."""

    def __init__(self, path: str, remembered: int = REMEMBERED):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self._added = [token["content"] for token in spec.get("added_tokens") or []]
        self._code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype("<u2" if self._code == "H" else "<u4")
        self._lower, self._split = self._fast_steps(spec)
        self._remembered = remembered
        self._first: dict[str, bytes | bool] = {}
        self._later: dict[str, bytes | bool] = {}
        self._units: dict[str, bytes] = {}

    @staticmethod
    def _fast_steps(spec: dict):
        """Whether texts are lower-cased, and a function cutting plain text into pre-tokens.

        Known are the two layouts of byte-level files; for others the function is None and all
        steps are the library's.
        """
        cut = spec["pre_tokenizer"] or {}
        names = [step["type"] for step in (spec["normalizer"] or {}).get("normalizers", [])]
        if spec["normalizer"] is None and cut.get("type") == "ByteLevel":
            if cut["use_regex"] and not cut["add_prefix_space"]:
                return False, regex.compile(BYTE_LEVEL_PATTERN).findall
        elif names == ["NFC", "Replace", "Lowercase"] and cut.get("type") == "Sequence":
            first, second = cut["pretokenizers"]
            if first["behavior"] == "Removed" and first["invert"] and not second["use_regex"]:
                return True, regex.compile(first["pattern"]["Regex"]).findall
        return False, None

    def _bytes(self, ids: list[int]) -> bytes:
        out = array(self._code, ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def whole(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _unit(self, unit: str) -> bytes:
        """Ids of one pre-token, by the tokenizer's model."""
        if unit.isascii() and unit.isprintable():
            mapped = unit.replace(" ", _BYTE_CHARACTERS[32])
        else:
            mapped = unit.encode().decode("latin-1").translate(_BYTE_CHARACTERS)
        self._units[unit] = ids = self._bytes([t.id for t in self.tokenizer.model.tokenize(mapped)])
        return ids

    def _piece(self, text: str) -> bytes:
        """Ids of one piece, cut into pre-tokens whose ids are remembered."""
        if self._split is None or (not text.isascii() and max(text) >= _PLAIN):
            return self.whole(text)
        known, out = self._units.get, []
        for unit in self._split(text.lower() if self._lower else text):
            ids = known(unit)
            out.append(self._unit(unit) if ids is None else ids)
        return out[0] if len(out) == 1 else b"".join(out)

    def _learn(self, lead: str, piece: str) -> bytes | bool:
        """Ids of a piece that can stand alone, or False."""
        if not piece or piece[0].isspace() or piece[-1].isspace():
            return False
        for added in self._added:
            if added in piece:
                return False
        return self._piece(lead + piece)

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        first, later = self._first, self._later
        if len(first) + len(later) + len(self._units) > self._remembered:
            first.clear(), later.clear(), self._units.clear()
        start, *rest = text.split(" ")
        if start not in first:
            first[start] = self._learn("", start)
        found = list(map(later.get, rest))
        if None in found:
            for at, piece in enumerate(rest):
                if found[at] is None:
                    ids = later.get(piece)
                    if ids is None:
                        ids = later[piece] = self._learn(" ", piece)
                    found[at] = ids
        try:
            return b"".join([first[start], *found])
        except TypeError:  # a piece that cannot stand alone
            return self.whole(text)


@lru_cache(maxsize=2)
def encoder(path: str) -> TextEncoder:
    """The worker's encoder for this file."""
    return TextEncoder(path)


def forget() -> None:
    """Give up the worker's encoders and the pieces they remember: workers go on to other operators."""
    if encoder.cache_info().currsize:
        encoder.cache_clear()

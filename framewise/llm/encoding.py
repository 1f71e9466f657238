"""Token ids of texts of any length, as the ``tokenizers`` library gives them.

For byte-level BPE, ``tiktoken`` gives the same ids from the same vocabulary in a quarter of
the time. It is used for texts of well-settled characters only; where the two libraries may know
different Unicode versions, ``tokenizers`` itself encodes.

Huge texts are encoded in overlapping chunks. Neighbours are spliced at a place that is proven
stable and at which both have a token boundary: before a blank that follows a visible ASCII
character. No pre-token of the byte-level pattern holds a blank after another character, so at such
a place the ids of the parts are the ids of the whole, whatever stands around them. Where the
overlap has no such place, it is widened, up to the end of the text.
"""

from __future__ import annotations

import json
import re
from functools import cached_property, lru_cache

import numpy as np

#: Bytes of a chunk, and of the overlap with the next one to begin with.
CHUNK = 1 << 16
OVERLAP = 1 << 8

#: Characters whose classes have not changed since long before either library: ASCII, Latin
#: letters and general punctuation.
_SETTLED = re.compile("[\\x00-\\u024f\\u2010-\\u2027\\u2030-\\u203a\\u20ac]*")

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0D]] = True
_VISIBLE = np.array([0x21 <= i <= 0x7E for i in range(256)])

#: Fixed value: the pre-tokenizer pattern that the library's ByteLevel step applies.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _bytes_of_symbols() -> dict[str, int]:
    """Byte-level vocabularies write each byte as one printable character: visible Latin-1 ones
    as they are, the others as the characters from 256 on, in order."""
    shown = [i for i in range(256) if 0x21 <= i <= 0x7E or 0xA1 <= i <= 0xAC or 0xAE <= i]
    hidden = [i for i in range(256) if i not in shown]
    return {chr(i): i for i in shown} | {chr(256 + n): i for n, i in enumerate(hidden)}


class Encoder:
    """Ids of texts by a byte-level BPE file of ``tokenizers``."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP):
        import tiktoken

        self.path, self.chunk, self.overlap = path, chunk, overlap
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        symbols = _bytes_of_symbols()
        special = {t["content"]: t["id"] for t in content["added_tokens"]}
        ranks = {
            bytes(symbols[c] for c in token): i for token, i in content["model"]["vocab"].items() if token not in special
        }
        self._fast = tiktoken.Encoding("same", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self._bytes = np.zeros(max([*ranks.values(), *special.values()]) + 1, np.int64)
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in special.items())]:
            self._bytes[i] = len(token)

    @cached_property
    def _library(self):
        """Only loaded where a text needs it."""
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return library

    def ids(self, text: str) -> np.ndarray:
        """The ids, unsigned 32-bit."""
        if len(text) <= self.chunk:
            return self._whole(text)
        return np.concatenate(list(self._spliced(text.encode())))

    def library_ids(self, text: str) -> np.ndarray:
        """The ids by the library alone, for comparison."""
        return np.array(self._library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _whole(self, text: str) -> np.ndarray:
        if _SETTLED.fullmatch(text):
            return np.array(self._fast.encode(text, allowed_special="all"), np.uint32)
        return self.library_ids(text)

    def _encoded(self, data: bytes, begin: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a stretch, and the offset in the whole at which each token begins."""
        ids = self._whole(data[begin:end].decode())
        return ids, begin + np.concatenate(([0], np.cumsum(self._bytes[ids])[:-1])).astype(np.int64)

    @staticmethod
    def _stable(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """Of the offsets, those at which the text may be cut."""
        inner = begins[begins > 0]
        return inner[_BLANK[data[inner]] & _VISIBLE[data[inner - 1]]]

    def _spliced(self, data: bytes):
        """Ids of consecutive stretches, each cut out of one chunk."""
        array, size = np.frombuffer(data, np.uint8), len(data)

        def whole_character(at: int) -> int:
            while at < size and data[at] & 0xC0 == 0x80:
                at += 1
            return min(at, size)

        begin = 0
        while True:
            middle, overlap = whole_character(begin + self.chunk), self.overlap
            while True:
                end = whole_character(middle + overlap)
                ids, begins = self._encoded(data, begin, end)
                if end == size:
                    yield ids
                    return
                # On the right, what comes before its first blank may be torn.
                _, after = self._encoded(data, middle, whole_character(end + overlap))
                common = np.intersect1d(self._stable(array, begins[begins > middle]), self._stable(array, after[after > middle]))
                if len(common):
                    break
                overlap *= 2
            cut = int(common[-1])
            yield ids[begins < cut]
            begin = cut


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file."""
    return Encoder(path)

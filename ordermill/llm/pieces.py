"""SentencePiece models: normalisation with source alignment, cached encoding, decoding.

The file is read for its pieces and its normaliser. Normalisation walks the compiled character map
(a double-array trie) by longest prefix and keeps, for every normalised byte, the source byte it came
from; that lets every piece be projected to the bytes of the original text it stands for.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import sentencepiece

SPACE = "▁"  # the mark that stands for a space in pieces
SPACE_BYTES = SPACE.encode()
CACHED_WORDS = 250_000
CACHED_LENGTH = 48
_SEGMENT = re.compile(" +[^ ]*")


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field number and value of each field of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        kind = tag & 7
        if kind == 0:
            yield tag >> 3, number()
        else:
            size = number() if kind == 2 else 8 if kind == 1 else 4
            yield tag >> 3, data[at : at + size]
            at += size


class Normaliser:
    """The normaliser of a model: character map, dummy prefix and white space rules."""

    def __init__(self, spec: bytes = b""):
        fields = dict(_fields(spec))
        charsmap = fields.get(2, b"")
        self.add_dummy_prefix = bool(fields.get(3, 1))
        self.remove_extra_whitespaces = bool(fields.get(4, 1))
        self.escape_whitespaces = bool(fields.get(5, 1))
        self.units, self.replacements = [], b""
        if charsmap:
            size = int.from_bytes(charsmap[:4], "little")
            self.units = np.frombuffer(charsmap[4 : 4 + size], "<u4").tolist()
            self.replacements = charsmap[4 + size :]

    @property
    def plain(self) -> bool:
        """Only spaces change, each on its own."""
        return not self.units and not self.remove_extra_whitespaces

    def longest_prefix(self, data: bytes, at: int) -> tuple[int, bytes]:
        """Bytes that the character map replaces at `at`, and what by; (0, b"") for none."""
        units = self.units
        found, value = 0, 0
        node = 0
        unit = units[0]
        node ^= (unit >> 10) << ((unit & 512) >> 6)
        for position in range(at, len(data)):
            byte = data[position]
            node ^= byte
            unit = units[node]
            if unit & 0x800000FF != byte:
                break
            node ^= (unit >> 10) << ((unit & 512) >> 6)
            if unit & 256:
                found, value = position + 1 - at, units[node] & 0x7FFFFFFF
        if not found:
            return 0, b""
        return found, self.replacements[value : self.replacements.index(b"\0", value)]

    def _steps(self, data: bytes) -> Iterator[tuple[int, int, bytes]]:
        """Source start and end of each unit, and its replacement."""
        at = 0
        while at < len(data):
            size, new = self.longest_prefix(data, at) if self.units else (0, b"")
            if not size:
                lead = data[at]
                size = 1 if lead < 192 else 2 if lead < 224 else 3 if lead < 240 else 4
                new = data[at : at + size]
            yield at, at + size, new
            at += size

    def __call__(self, data: bytes) -> tuple[bytes, np.ndarray]:
        """Normalised bytes; for each of them, and for their end, the offset in the source.

        A replacement's bytes all start where the bytes they replace start.
        """
        if not data:
            return b"", np.zeros(1, np.int64)
        if self.plain:
            return self._spaces_only(data)
        mark = SPACE_BYTES if self.escape_whitespaces else b" "
        out, origin = bytearray(), []
        steps = list(self._steps(data))
        if self.remove_extra_whitespaces:
            while steps and not steps[0][2].strip(b" "):
                steps.pop(0)
        if not steps:
            return b"", np.full(1, len(data), np.int64)
        if self.add_dummy_prefix:
            out += mark
            origin += [steps[0][0]] * len(mark)
        end = steps[0][0]
        spaced = self.remove_extra_whitespaces
        for start, stop, new in steps:
            if spaced:
                new = new.lstrip(b" ")
            if new:
                for byte in new:
                    piece = mark if byte == 32 else bytes((byte,))
                    out += piece
                    origin += [start] * len(piece)
                spaced = self.remove_extra_whitespaces and new.endswith(b" ")
                end = stop
            elif not self.remove_extra_whitespaces:
                end = stop
        if self.remove_extra_whitespaces:
            while out.endswith(mark):
                end = origin[-1]
                del out[-len(mark) :], origin[-len(mark) :]
        return bytes(out), np.array([*origin, end], np.int64)

    def _spaces_only(self, data: bytes) -> tuple[bytes, np.ndarray]:
        source = np.frombuffer(data, np.uint8)
        width = len(SPACE_BYTES) if self.escape_whitespaces else 1
        origin = np.arange(len(source) + 1)
        if width > 1:
            origin = np.repeat(origin, np.append(np.where(source == 32, width, 1), 1))
            data = data.replace(b" ", SPACE_BYTES)
        if self.add_dummy_prefix:
            data = (SPACE_BYTES if width > 1 else b" ") + data
            origin = np.concatenate([np.zeros(width, origin.dtype), origin])
        return data, origin


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Pieces:
    """A model file with byte fallback: ids of texts, spans of ids, texts of ids."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            data = file.read()
        self.library = sentencepiece.SentencePieceProcessor(model_proto=data)
        spec, widths, inner = b"", [], False
        for number, value in _fields(data):
            if number == 3:
                spec = value
            elif number == 1:
                piece = dict(_fields(value))
                text, kind = piece.get(1, b""), piece.get(3, 1)
                # types of pieces in the file: 1 normal, 2 unknown, 3 control, 6 byte
                widths.append(0 if kind in (2, 3) else 1 if kind == 6 else len(text))
                inner |= SPACE_BYTES in text.lstrip(SPACE_BYTES)
        self.normaliser = Normaliser(spec)
        self.widths = np.array(widths, np.int64)
        if not any(self.library.is_byte(i) for i in range(len(widths))):
            raise ValueError("a model with byte fallback is needed")
        #: No piece goes on past a space, so words are encoded alone.
        self.by_word = self.normaliser.plain and self.normaliser.add_dummy_prefix and not inner
        self.lone_space = _packed([self.library.piece_to_id(SPACE)])
        self.cache: dict[str, bytes] = {"": self.lone_space}

    def words(self, text: str) -> list[str] | None:
        """Parts of a text that are encoded alone, each without the space before it.

        None: the text is to be encoded whole, for it has the mark of a space itself.
        """
        if not self.by_word or SPACE in text:
            return None
        words = text.split(" ")
        if "" in words:  # several spaces, or one at an end: they stay with the word after them
            words = [found[1:] for found in _SEGMENT.findall(" " + text)]
        return words

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as little-endian unsigned 32-bit integers."""
        return [_packed(ids) if word else self.lone_space for word, ids in zip(words, self.library.encode(words, num_threads=1))]

    def encode(self, text: str) -> bytes:
        """Ids of a text, as little-endian unsigned 32-bit integers, without begin and end."""
        if not text:
            return b""
        words = self.words(text)
        if words is None:
            return _packed(self.library.encode(text))
        cache = self.cache
        found = list(map(cache.get, words))
        if None in found:
            missing = list({word for word, ids in zip(words, found) if ids is None})
            if len(cache) > CACHED_WORDS:
                cache.clear()
                cache[""] = self.lone_space
            fresh = dict(zip(missing, self.encode_words(missing)))
            found = [fresh[word] if ids is None else ids for word, ids in zip(words, found)]
            cache.update((word, ids) for word, ids in fresh.items() if len(word) <= CACHED_LENGTH)
        return b"".join(found)

    def spans(self, text: str, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every id in the bytes of the text; control ids are empty."""
        _, origin = self.normaliser(text.encode())
        ends = np.cumsum(self.widths[ids])
        if len(ends) and ends[-1] != len(origin) - 1:
            raise ValueError("the pieces do not add up to the normalised text")
        return origin[ends - self.widths[ids]], origin[ends]


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """One model per worker process, with its cache of words."""
    return Pieces(path)

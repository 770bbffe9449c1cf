"""Memoised pre-tokenisation shared by the tokenising operators.

No piece of either public pattern reaches across a word boundary in a way that
depends on the far word, so a text is cut into white-space-delimited chunks by
``str.split`` and each distinct chunk is pre-tokenised and encoded once; a
bounded memo holds the ids of recent chunks. Texts whose white space does not
allow that cut go through the pattern as a whole.
"""
from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterator

import regex

# --- fixed values: the public patterns of the two vocabularies ---
BYTE_LEVEL = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+")

#: Entries of the memos, about 250 bytes each: of a Python worker's memory, some 125 MB at most for words.
#: Workers live on idle and keep them through later stages of a pipeline; the byte level runs by itself.
CHUNKS, PIECES = 400_000, 100_000
BYTE_LEVEL_CHUNKS, BYTE_LEVEL_PIECES = 1_500_000, 400_000
#: Texts are encoded in slices of about this many characters.
SLICE_CHARS = 1 << 18

_LETTERS = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
_RUN_START = re.compile(r"(?<!\s)\s")
#: ``str.split`` takes these for white space, the patterns don't.
_SEPARATORS = "\x1c\x1d\x1e\x1f"
#: White space that the byte-level cut does not handle.
_UNUSUAL = [chr(c) for c in (0x09, 0x0B, 0x0C, 0x0D, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                             0x202F, 0x205F, 0x3000)]


def slices(text: str, size: int = SLICE_CHARS) -> Iterator[str]:
    """``text`` in slices that start at the first character of a run of white space.

    No piece, combining sequence or contraction spans such a place.
    """
    at = 0
    while len(text) - at > size:
        m = _RUN_START.search(text, at + size)
        if not m:
            break
        yield text[at:m.start()]
        at = m.start()
    yield text[at:] if at else text


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    names = {b: chr(b) for b in printable}
    rest = (b for b in range(256) if b not in names)
    names.update((b, chr(256 + k)) for k, b in enumerate(rest))
    return [names[b] for b in range(256)]


class Memo:
    """Bounded memo from a string to its ids as little-endian 32-bit bytes.

    Two generations of ``most // 2`` entries: when the young one is full it
    becomes the old one, and what is met again moves back. Frequent strings
    stay, however many rare ones pass.
    """

    def __init__(self, encode_new: Callable[[list[str]], list[bytes]], most: int = 500_000, longest: int = 64):
        self.encode_new, self.half, self.longest = encode_new, most // 2, longest
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def __call__(self, keys: list[str]) -> list[bytes]:
        known, missing = self.known, set(keys).difference(self.known)
        if missing:
            old = self.old
            known.update((k, old[k]) for k in missing if k in old)
            new = [k for k in missing if k not in old]
            known.update(zip(new, self.encode_new(new)))
        got = list(map(known.__getitem__, keys))
        if missing:
            for k in missing:
                if len(k) > self.longest:
                    del known[k]
            if len(known) > self.half:
                self.old, self.known = dict(itertools.islice(known.items(), self.half)), {}
        return got


class ChunkEncoder:
    """Encodes texts chunk by chunk; ``encode_pieces`` turns new pieces into ids."""

    def __init__(self, encode_pieces: Callable[[list[str]], list[bytes]], chunks: int = CHUNKS, pieces: int = PIECES):
        self.pieces = Memo(encode_pieces, pieces)
        self.chunks = Memo(self._new_chunks, chunks)

    def cut(self, chunk: str) -> list[str]:
        raise NotImplementedError

    def _new_chunks(self, chunks: list[str]) -> list[bytes]:
        cut = [self.cut(c) for c in chunks]
        ids = iter(self.pieces([p for pieces in cut for p in pieces]))
        return [b"".join([next(ids) for _ in pieces]) for pieces in cut]

    def encode(self, text: str) -> bytes:
        raise NotImplementedError


class ByteLevelChunks(ChunkEncoder):
    """The byte-level pattern: a space opens the next word, every character counts."""

    def __init__(self, encode_pieces: Callable[[list[str]], list[bytes]]):
        super().__init__(encode_pieces, BYTE_LEVEL_CHUNKS, BYTE_LEVEL_PIECES)

    def cut(self, chunk: str) -> list[str]:
        if _LETTERS.fullmatch(chunk):  # the pattern takes them whole
            return [" " + chunk]
        return BYTE_LEVEL.findall(chunk if chunk[0] == "\n" else " " + chunk)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        first, *rest = text.replace("\n", " \n").split(" ")
        # runs of white space, and any at the ends, belong to no single chunk
        if not first or "" in rest or "\n" in rest or any(c in text for c in _UNUSUAL):
            return b"".join(self.pieces(BYTE_LEVEL.findall(text)))
        return b"".join(self.pieces(BYTE_LEVEL.findall(first)) + self.chunks(rest))


class WordChunks(ChunkEncoder):
    """The word pattern: white space is dropped, ``normalise`` works within words."""

    def __init__(self, encode_pieces, normalise: Callable[[str], str]):
        super().__init__(encode_pieces)
        self.normalise = normalise

    def cut(self, chunk: str) -> list[str]:
        return WORDS.findall(self.normalise(chunk))

    def encode(self, text: str) -> bytes:
        if any(c in text for c in _SEPARATORS):
            return b"".join(self.pieces(self.cut(text)))
        return b"".join(self.chunks(text.split()))


def split_special(text: str, special: re.Pattern | None) -> list[str]:
    """Alternating ordinary text and special-token strings (odd places)."""
    if special is None or special.search(text) is None:
        return [text]
    return special.split(text)


def special_pattern(contents: list[str]) -> re.Pattern | None:
    if not contents:
        return None
    return re.compile("(" + "|".join(re.escape(c) for c in sorted(contents, key=len, reverse=True)) + ")")

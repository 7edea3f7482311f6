"""Words of a text, at the speed of the byte functions of Python.

Both rules look at ASCII only: bytes above 0x7F belong to characters that are
part of a word under either, so UTF-8 can be cut without decoding it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_TO_LOWER = bytes.maketrans(_UPPER, _LOWER)
_WORD = frozenset(range(48, 58)) | frozenset(range(97, 123)) | frozenset(range(128, 256))
_TO_WORDS = bytes(c if c in _WORD else 32 for c in _TO_LOWER)


def plain_words(text: bytes | None) -> list[bytes]:
    """Runs of [^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F] with A-Z lowered; none for null."""
    return text.translate(_TO_WORDS).split() if text else []


_PLAIN = np.array([c in _WORD for c in range(256)])
_SPACED = np.array([c not in b" \t\n\v\f\r" for c in range(256)])
_PIECE = 2**16
_BYTES = np.random.default_rng(3).integers(1, 2**63, 256, np.uint64)
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be divided out again


def _powers(base: int, count: int) -> np.ndarray:
    return np.full(count, base, np.uint64).cumprod(dtype=np.uint64)


_UP, _BACK = _powers(_BASE, _PIECE), _powers(pow(_BASE, -1, 2**64), _PIECE)


def _pieces(text: bytes, in_word: np.ndarray) -> Iterator[np.ndarray]:
    """The text in pieces of about `_PIECE` bytes that do not cut words."""
    whole = np.frombuffer(text, np.uint8)
    while len(whole) > _PIECE:
        gaps = np.flatnonzero(~in_word[whole[:_PIECE]])
        if len(gaps):
            cut = int(gaps[-1]) + 1
        else:  # a word longer than a piece
            cut = next((k for k in range(_PIECE, len(whole)) if not in_word[whole[k]]), len(whole))
        yield whole[:cut]
        whole = whole[cut:]
    yield whole


def _numbers(text: bytes | None, in_word: np.ndarray) -> np.ndarray:
    """A 64-bit number for each run of bytes in a word, with A-Z lowered.

    It is a polynomial in the bytes, for all words at once: the difference of two
    prefix sums, with the power of the place where the word starts divided out.
    """
    if not text:
        return np.empty(0, np.uint64)
    found = []
    for piece in _pieces(text.translate(_TO_LOWER), in_word):
        up, back = _UP, _BACK
        if len(piece) > _PIECE:
            up, back = _powers(_BASE, len(piece)), _powers(pow(_BASE, -1, 2**64), len(piece))
        edges = np.flatnonzero(np.diff(in_word[piece], prepend=False, append=False))
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTES[piece] * up[: len(piece)], out=sums[1:])
        starts = edges[::2]
        found.append((sums[edges[1::2]] - sums[starts]) * back[starts])
    return np.concatenate(found)


def plain_word_numbers(text: bytes | None) -> np.ndarray:
    """64-bit numbers of the `plain_words` of the text."""
    return _numbers(text, _PLAIN)


def spaced_word_numbers(text: bytes | None) -> np.ndarray:
    """64-bit numbers of the runs of [^\\x20\\x09-\\x0D], with A-Z lowered; none for null."""
    return _numbers(text, _SPACED)


def word_places(text: bytes) -> list[tuple[int, int]]:
    """Where each of `plain_words` starts and ends in the bytes of the text."""
    inside = _PLAIN[np.frombuffer(text.translate(_TO_LOWER), np.uint8)]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))

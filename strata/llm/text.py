"""Word splitting shared by the operators.

Texts are handled as UTF-8 bytes: lower-casing touches A-Z alone and every
byte of a non-ASCII character counts as a word byte, so splitting bytes and
splitting characters give the same words.
"""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: ASCII letters and digits and everything beyond ASCII are word bytes; the rest becomes a blank.
_WORD_LOWER = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32
                    for c in range(256))


def raw(text) -> bytes:
    """UTF-8 bytes; a missing text is empty."""
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def alnum_words(text) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return raw(text).translate(_WORD_LOWER).split()


def alnum_spans(text) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The bytes of a text, and the byte offsets where each of ``alnum_words`` starts and ends."""
    data = raw(text)
    inside = np.frombuffer(data.translate(_WORD_LOWER), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    return data, edges[0::2], edges[1::2]


def space_words(text, lower: bool = True) -> list[bytes]:
    """Runs of anything but blank, tab, line feed, vertical tab, form feed, carriage return."""
    data = raw(text)
    return (data.translate(_LOWER) if lower else data).split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def combine(columns, length: int, seed: int = 0) -> np.ndarray:
    """One 64-bit hash for each row of the columns, which all have ``length`` rows."""
    out = np.full(length, np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (2**64 - 1)))
    for column in columns:
        out = mix(out * np.uint64(0x100000001B3) + column.astype(np.uint64))
    return out


def window_hashes(values: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """One 64-bit hash for each run of ``n`` consecutive values (none if there are fewer)."""
    count = max(0, len(values) - n + 1)
    return combine((values[k:k + count] for k in range(n)), count, seed)


def covered(starts: np.ndarray, n: int, length: int) -> np.ndarray:
    """Which of ``length`` positions lie in a window of ``n`` that begins at one of ``starts``."""
    step = np.bincount(starts, minlength=length + 1) - np.bincount(starts + n, minlength=length + 1)
    return np.cumsum(step[:-1]) > 0


def give_back() -> None:
    """Return freed memory to the system, at the end of a task.

    Python workers are used again by later stages, and they share one limit with
    the executor's JVM: what a task has freed would else stay with its worker.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
    if trim is not None:
        trim(0)

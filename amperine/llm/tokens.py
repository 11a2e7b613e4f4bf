"""Texts as numpy arrays: code points, tokens and their hashes, a batch at a time."""

from __future__ import annotations

from functools import lru_cache
from typing import NamedTuple

import numpy as np

BLANK, LETTER, DIGIT, SIGN = range(4)
PREFIX = 5
_PRIME = 0x9E3779B97F4A7C15


@lru_cache(1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Kind, lower case and whether it is upper case, for code points of the first plane."""
    chars = [chr(i) for i in range(0x10000)]
    kind = np.array([_kind(c) for c in chars], np.uint8)
    lower = np.array([ord(c.lower()) if len(c.lower()) == 1 else ord(c) for c in chars], np.uint32)
    return kind, lower, np.array([c.isupper() for c in chars])


def _kind(c: str) -> int:
    return LETTER if c.isalpha() else DIGIT if c.isdigit() else BLANK if c.isspace() else SIGN


@lru_cache(1 << 16)
def _far(code: int) -> tuple[int, int, bool]:
    """Kind, lower case and case of a code point beyond the first plane."""
    c = chr(code)
    return _kind(c), ord(c.lower()) if len(c.lower()) == 1 else code, c.isupper()


@lru_cache(1)
def _powers() -> np.ndarray:
    powers = [1]
    for _ in range(255):
        powers.append(powers[-1] * _PRIME % 2**64)
    return np.array(powers, np.uint64)


def spell(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Kind, lower-case code point and upper-case mark of every character, and its text.

    Every text is preceded by one blank.
    """
    joined = "\n" + "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    kind, lower, upper = _tables()
    low = np.minimum(codes, 0xFFFF)
    kinds, lowered, raised = kind[low], lower[low], upper[low]
    beyond = np.flatnonzero(codes > 0xFFFF)
    if len(beyond):
        seen, which = np.unique(codes[beyond], return_inverse=True)
        far = [_far(int(c)) for c in seen]
        kinds[beyond] = np.array([f[0] for f in far], np.uint8)[which]
        lowered[beyond] = np.array([f[1] for f in far], np.uint32)[which]
        raised[beyond] = np.array([f[2] for f in far])[which]
    return kinds, lowered, raised, np.repeat(np.arange(len(texts)), lengths)


class Tokens(NamedTuple):
    """Runs of letters, of digits, and of one sign, in order."""

    hash: np.ndarray
    prefix: np.ndarray  # hash of the first PREFIX characters
    kind: np.ndarray
    length: np.ndarray
    shouted: np.ndarray  # two or more letters, all upper case
    text: np.ndarray


def tokens(texts: list[str]) -> Tokens:
    kinds, codes, upper, text = spell(texts)
    cut = np.ones(len(kinds), bool)
    cut[1:] = (kinds[1:] != kinds[:-1]) | ((kinds[1:] == SIGN) & (codes[1:] != codes[:-1]))
    starts = np.flatnonzero(cut)
    lengths = np.diff(np.append(starts, len(kinds)))
    place = np.arange(len(kinds)) - np.repeat(starts, lengths)
    values = (codes.astype(np.uint64) + 1) * _powers()[place & 255]
    real = kinds[starts] != BLANK
    whole = np.add.reduceat(values, starts)[real]
    values[place >= PREFIX] = 0
    first = np.add.reduceat(values, starts)[real]
    raised = np.add.reduceat(upper.astype(np.int64), starts)[real]
    return Tokens(
        mixed(whole), mixed(first), kinds[starts][real], lengths[real],
        (raised == lengths[real]) & (lengths[real] > 1), text[starts][real],
    )


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads the entropy of 64-bit hashes over all their bits."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of logits with the least log loss on rows the model was not fitted to.

    logits: rows by classes. Without rows it is 1.
    """
    if not len(labels):
        return 1.0
    def loss(t: float) -> float:
        z = logits / t
        z = z - z.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(1)) - z[np.arange(len(labels)), labels]))

    return float(min(np.geomspace(0.2, 10, 60), key=loss))

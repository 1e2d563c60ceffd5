"""Array kernels on texts: rolling hashes, sliding minima and words, for many texts at once."""

from __future__ import annotations

import numpy as np

#: An odd multiplier for polynomial hashes modulo 2**64, and its inverse.
BASE = 0x5851F42D4C957F2D
_UNBASE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept for the next call."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        run = np.full(size, base, np.uint64)
        run[0] = 1
        have = _powers[base] = np.cumprod(run, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


class Rolling:
    """Hashes of any stretch of a sequence, from prefix sums of its polynomial."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((values + np.uint64(1)) * powers(BASE, n), out=self.sums[1:])
        self.undo = powers(_UNBASE, n + 1)

    def every(self, width: int) -> np.ndarray:
        """Hashes of all stretches of one width."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.undo[:n]) if n > 0 else np.zeros(0, np.uint64)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of given stretches, not yet mixed."""
        return (self.sums[end] - self.sums[start]) * self.undo[start]


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every stretch of that width, by doubling widths."""
    if len(x) < width:
        return x[:0]
    have = 1
    while 2 * have <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = width - have
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts in a row, and the bounds between texts."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64), bounds


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(65, 91), 95, *range(97, 123)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Maximal runs of ASCII letters, digits and underscores, without case, of all texts.

    Returns the hash, the text's number, the first byte and the end of each word, and the bytes of all texts, with a
    separator after each. Bytes beyond ASCII only separate, so no text needs decoding.
    """
    parts = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(parts) + b"\n"
    raw = np.frombuffer(data, np.uint8)
    flag = _WORD[raw]
    edge = np.flatnonzero(np.diff(flag.view(np.int8), prepend=np.int8(0)))
    start, end = edge[::2], edge[1::2]
    bounds = np.cumsum([len(p) + 1 for p in parts])
    value = mix(Rolling(_LOWER[raw].astype(np.uint64)).of(start, end) + (end - start).astype(np.uint64))
    return value, np.searchsorted(bounds, start, side="right"), start, end, data


def chunks(rows, size_of, limit: int):
    """Runs of rows of about ``limit`` in total; a larger row is a run of its own."""
    run, total = [], 0
    for row in rows:
        n = size_of(row)
        if run and total + n > limit:
            yield run
            run, total = [], 0
        run.append(row)
        total += n
    if run:
        yield run

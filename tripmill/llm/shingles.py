"""Word codes and word n-gram codes of texts, as arrays."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE = 1 << 20  # bytes that are worked on at a time
GAPS = np.zeros(256, bool)
GAPS[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = bytes(range(256)).translate(bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))

U64 = np.uint64
STEP = U64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (the public-domain splitmix64 finaliser)."""
    x = x + STEP
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODES = mixed(np.arange(1, 257, dtype=U64))


def powers(base: U64, n: int) -> np.ndarray:
    out = np.full(n, base, U64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _slice_codes(buffer: np.ndarray) -> np.ndarray:
    inside = ~GAPS[buffer]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, U64)
    lengths = ends - starts
    at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    weights = powers(STEP | U64(1), int(lengths.max()))
    sums = np.add.reduceat(BYTE_CODES[buffer[inside]] * weights[at], np.cumsum(lengths) - lengths)
    return mixed(sums ^ (lengths.astype(U64) << U64(48)))


def word_codes(text: bytes) -> np.ndarray:
    """A 64-bit code for each word of a text; words lie between the six ASCII white-space characters."""
    buffer = np.frombuffer(text, np.uint8)
    if len(buffer) <= SLICE:
        return _slice_codes(buffer)
    parts, at = [], 0
    while at < len(buffer):
        end = min(at + SLICE, len(buffer))
        while end < len(buffer) and not GAPS[buffer[end]]:
            end += 1
        parts.append(_slice_codes(buffer[at:end]))
        at = end
    return np.concatenate(parts)


def joined_codes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the words of all texts in one array, and where each text begins in it (one more entry than texts)."""
    codes = [word_codes(text) for text in texts] if sum(map(len, texts)) > SLICE else None
    if codes is None:
        # Short texts together; the words of each are counted by those that begin before its end.
        sizes = np.array([len(text) + 1 for text in texts])
        buffer = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        inside = ~GAPS[buffer]
        starts = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0) == 1)
        bounds = np.concatenate([[0], np.searchsorted(starts, np.cumsum(sizes))])
        return _slice_codes(buffer), bounds
    bounds = np.concatenate([[0], np.cumsum([len(c) for c in codes])])
    return np.concatenate(codes) if codes else np.zeros(0, U64), bounds


def gram_codes(codes: np.ndarray, n: int, base: U64 = STEP | U64(1)) -> np.ndarray:
    """Codes of the n-grams that begin at each word; shorter by n - 1."""
    if len(codes) < n:
        return np.zeros(0, U64)
    total = np.zeros(len(codes) - n + 1, U64)
    block, width, done = codes, 1, 0
    factor, weight = base, U64(1)
    with np.errstate(over="ignore"):
        while True:  # blocks of 1, 2, 4 ... words; those of n's binary digits are added up
            if n & width:
                total = total + weight * block[done : done + len(total)]
                done += width
                weight = weight * factor
            if 2 * width > n:
                return mixed(total)
            block = block[: len(block) - width] + factor * block[width:]
            factor, width = factor * factor, 2 * width


def sliding(values: np.ndarray, n: int, pick=np.minimum) -> np.ndarray:
    """The least (or what `pick` takes) of the n values that begin at each place; shorter by n - 1."""
    if len(values) < n:
        return values[:0]
    width = 1
    while 2 * width <= n:
        values = pick(values[: len(values) - width], values[width:])
        width *= 2
    rest = n - width
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def chunks(sizes: list[int], most: int = SLICE // 2) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose sizes sum up to about `most`."""
    begin, held = 0, 0
    for at, size in enumerate(sizes):
        held += size
        if held >= most:
            yield begin, at + 1
            begin, held = at + 1, 0
    if begin < len(sizes):
        yield begin, len(sizes)

"""Content-defined segments of byte strings (helper of ``suffix_dedup``).

Every window of ``length`` bytes selects one of its ``GRAM``-byte grams: the
one with the smallest hash, the rightmost of equals. Equal windows select
equal grams at equal places, wherever they stand. Consecutive windows that
select the same gram form a segment, so the segments of a text divide its
windows, and equal windows always lie in segments of the same gram.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

GRAM = 32
#: bytes worked on at once; positions must fit the packed hashes
PIECE = 1 << 19
_POS = np.uint64((1 << 20) - 1)
_M = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    rng = np.random.default_rng(3)
    odd = np.uint64(0x9E3779B97F4A7C15)
    power = np.cumprod(np.full(PIECE + 4096, odd), dtype=np.uint64)
    inverse = np.uint64(pow(int(odd), -1, 1 << 64))
    back = np.cumprod(np.full(PIECE + 4096, inverse), dtype=np.uint64)
    return (rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
            rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1), power, back)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(29)) * _M
    return h ^ h >> np.uint64(32)


def segments(texts: list[bytes], length: int = 200) -> tuple[np.ndarray, ...]:
    """``(text, first, windows, gram hash, segment hash)`` of every segment;
    ``texts`` together are at most about ``PIECE`` bytes (see ``pieces``).
    The segment hash is that of its bytes and of the gram's place in it."""
    first_table, second_table, power, back = _tables()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1])) if len(texts) else sizes
    buf = np.frombuffer(b"".join(texts), np.uint8)
    n = len(buf) - length + 1
    none = tuple(np.empty(0, np.int64) for _ in range(3)) + tuple(np.empty(0, np.uint64) for _ in range(2))
    if n <= 0:
        return none
    h = first_table[buf]
    step = 1
    while step < GRAM:  # hashes of 2, 4, ... GRAM bytes
        h = h[:-step] * np.uint64(2 * step * 0x51ED27 + 1) + h[step:]
        h ^= h >> np.uint64(31)
        step *= 2
    h = _mix(h)
    low = (h & ~_POS) | (_POS - np.arange(len(h), dtype=np.uint64))
    width, reach = length - GRAM + 1, 1
    while 2 * reach <= width:
        low = np.minimum(low[:-reach], low[reach:])
        reach *= 2
    if reach < width:
        low = np.minimum(low[:len(low) - (width - reach)], low[width - reach:])
    place = (_POS - (low & _POS)).astype(np.int64)
    # windows that stay inside one text
    inside = np.zeros(n + 1, np.int8)
    fits = sizes >= length
    np.add.at(inside, begin[fits], 1)
    np.add.at(inside, begin[fits] + sizes[fits] - length + 1, -1)
    inside = np.cumsum(inside[:n]) > 0
    starts = np.flatnonzero(inside)
    if not len(starts):
        return none
    place = place[starts]
    new = np.concatenate(([True], (place[1:] != place[:-1]) | (starts[1:] != starts[:-1] + 1)))
    head = np.flatnonzero(new)
    first = starts[head]
    windows = np.diff(np.append(head, len(starts)))
    gram = place[head]
    # content of each segment, from prefix sums
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(second_table[buf] * power[:len(buf)], out=total[1:])
    end = first + windows + length - 1
    content = (total[end] - total[first]) * back[first]
    content = _mix(content + (windows.astype(np.uint64) << np.uint64(32)) + (gram - first).astype(np.uint64) * _M)
    text = np.searchsorted(begin, first, side="right") - 1
    return text, first - begin[text], windows, h[gram], content


def pieces(texts: list[bytes], length: int = 200):
    """Yield ``(texts, rows, offsets)`` of about ``PIECE`` bytes: whole texts,
    or a very long one in parts that share ``length - 1`` bytes."""
    batch, rows, offsets, size = [], [], [], 0
    for row, t in enumerate(texts):
        if len(t) < length:
            continue
        if size and size + len(t) > PIECE:
            yield batch, rows, offsets
            batch, rows, offsets, size = [], [], [], 0
        if len(t) <= PIECE:
            batch.append(t)
            rows.append(row)
            offsets.append(0)
            size += len(t)
            continue
        for a in range(0, len(t) - length + 1, PIECE - length + 1):
            yield [t[a:a + PIECE]], [row], [a]
    if batch:
        yield batch, rows, offsets

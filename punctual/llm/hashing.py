"""Words of texts as 64-bit hashes, vectorised over bytes.

A word is a run of characters other than ASCII white space, with A to Z in lower case. Equal words have equal hashes;
two of ``n`` different words share a hash with a chance of about ``n * n / 4e19``.

A word's hash is a difference of a running sum of byte values times powers of an odd number, taken back to power zero
and mixed; all arithmetic is modulo 2 to the 64. Texts are worked on in pieces of about ``PIECE_BYTES``, cut at white
space, so memory stays bounded by a piece (or by one word) plus eight bytes for each word of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PIECE_BYTES = 1 << 18
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of SplitMix64)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(1, 257, dtype=np.uint64))
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]


class _Powers:
    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def of(cls, length: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < length:
            size = max(length, PIECE_BYTES + 4096)
            for name, factor in (("up", _ODD), ("down", _INVERSE)):
                values = np.full(size, factor, np.uint64)
                values[0] = 1
                setattr(cls, name, np.multiply.accumulate(values))
        return cls.up, cls.down


def _spans(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.empty(len(raw) + 2, np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_SPACE[raw]
    change = np.diff(inside)
    return np.flatnonzero(change == 1), np.flatnonzero(change == -1)


def _hash_piece(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of one piece, and where they start."""
    starts, ends = _spans(raw)
    up, down = _Powers.of(len(raw))
    sums = np.empty(len(raw) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[raw] * up[: len(raw)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    return mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(_ODD)), starts


def _long(raw: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that end at white space."""
    at = 0
    while at < len(raw):
        end = at + PIECE_BYTES
        while end < len(raw):
            spaces = np.flatnonzero(_SPACE[raw[end : end + PIECE_BYTES]])
            if len(spaces):
                end += int(spaces[0])
                break
            end += PIECE_BYTES
        yield raw[at:end]
        at = end


def word_hashes(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words of ``texts`` in order, and the number of words of each text (0 for None)."""
    found, counts = [], np.zeros(len(texts), np.int64)
    at = 0
    while at < len(texts):
        size, last = 0, at
        while last < len(texts) and (last == at or size + len(texts[last] or b"") < PIECE_BYTES):
            size += len(texts[last] or b"") + 1
            last += 1
        if last == at + 1:
            for piece in _long(np.frombuffer(texts[at] or b"", np.uint8)):
                hashes, _ = _hash_piece(piece)
                found.append(hashes)
                counts[at] += len(hashes)
        else:
            part = [text or b"" for text in texts[at:last]]
            hashes, starts = _hash_piece(np.frombuffer(b" ".join(part), np.uint8))
            begins = np.cumsum([0, *(len(text) + 1 for text in part)])
            counts[at:last] = np.diff(np.searchsorted(starts, begins))
            found.append(hashes)
        at = last
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), counts


def binary_texts(column) -> list[bytes | None]:
    """The UTF-8 bytes of an Arrow string column."""
    import pyarrow as pa

    return column.cast(pa.binary()).to_pylist()

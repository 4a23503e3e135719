"""Byte-level BPE encoding and decoding from a rank file, by longest matches with backtracking.

A text is split by the tokenizer's pattern. A piece that is a token is that token. Any other piece is encoded left to
right: take the longest token at the current place; if it can't stand after the token before, try its next shorter
prefix that is a token; if none is left, take back the token before and go on with its shorter prefixes. Whether two
tokens can stand side by side is memoised: they can when merging their joined bytes by rank gives these two again.
Such an encoding is the only one whose neighbours are all compatible, and so is what the merges give. Places already
proven useless are marked, so the work is linear in the piece.

Bytes are mapped to Latin-1 characters, one each, so that the string automaton finds all tokens in a piece at once.

Ids are kept as little-endian unsigned 32-bit integers in a binary column, the form of flat token files.

Results in edge cases: a null or empty text has no tokens (empty binary) and decodes to empty bytes; a text of any
length is encoded whole; equal texts get equal ids; an empty table gives an empty table; the added columns replace input
columns of the same name. Lone surrogates cannot occur in Spark strings.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .arrow import give_back, with_mapped

# Bounds of the memos of one worker process. A full memo becomes the older one, which takes the place of the last older
# one: what is in use moves on, and a worker holds twice as many entries at most.
PIECE_MEMO = 49_152
PAIR_MEMO = 65_536
# Longer pieces are not memoised.
PIECE_BYTES = 32
# Texts that are encoded at a time where only the sizes of the decoded ones are wanted.
PORTION_ROWS = 64


class Tokenizer:
    """Encoder and decoder for one rank file and one split pattern; one per worker process."""

    def __init__(self, rank_path: str, pattern: str):
        import ahocorasick
        import regex

        self.ranks: dict[bytes, int] = {}
        with open(rank_path, "rb") as lines:
            for line in lines:
                if line.strip():
                    token, rank = line.split()
                    self.ranks[base64.b64decode(token)] = int(rank)
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.packed = {rank: rank.to_bytes(4, "little") for rank in self.tokens}
        self.findall = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        self.older_pieces: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self.older_pairs: dict[int, bool] = {}
        # Of each token that merging can reach: the two tokens joined last (none for a single byte), its length, and
        # the longest shorter prefix that is such a token. Others are used only where they are a whole piece.
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.lengths: dict[int, int] = {}
        self.shorter: dict[int, int | None] = {}
        self.automaton = ahocorasick.Automaton()
        for rank in sorted(self.tokens):
            token = self.tokens[rank]
            halves = self._last_merge(rank) if len(token) > 1 else None
            if halves is None and len(token) > 1:
                continue
            self.halves[rank], self.lengths[rank] = halves, len(token)
            self.automaton.add_word(token.decode("latin-1"), rank)
        for rank in self.halves:
            token = self.tokens[rank]
            prefixes = (self.ranks.get(token[:n]) for n in range(len(token) - 1, 0, -1))
            self.shorter[rank] = next((prefix for prefix in prefixes if prefix in self.halves), None)
        self.automaton.make_automaton()
        # By rank from here on: lists take a third of the memory that the mappings took while they were built.
        size = max(self.tokens, default=-1) + 1
        for name in ("tokens", "packed", "halves", "lengths", "shorter"):
            table = getattr(self, name)
            setattr(self, name, [table.get(rank) for rank in range(size)])

    def _last_merge(self, rank: int) -> tuple[int, int] | None:
        """The two tokens that merging joins last into this one; all of lower rank are known by now."""
        token = self.tokens[rank]
        for cut in range(1, len(token)):
            first, second = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
            if first in self.halves and second in self.halves and self._compatible(first, second, rank):
                return first, second
        return None

    def _compatible(self, first: int, second: int, below: float = float("inf")) -> bool:
        """Whether merging the joined bytes with ranks under ``below`` stops at these two tokens.

        Two tokens stay apart unless, at some stage of building them, the parts at their border form a token that
        merges before either part grows. So undo the merges at the border, the latest first, and look at each stage.
        """
        tokens, halves, rank_of = self.tokens, self.halves, self.ranks.get
        while True:
            joined = rank_of(tokens[first] + tokens[second])
            if joined is not None and joined < below:
                return False
            left, right = halves[first], halves[second]
            if left is None and right is None:
                return True
            # From here on a merge across the border has to come before the undone one. Of equal ranks the left place
            # is merged first, so the right one is undone first, and a merge of its own rank would still precede it.
            if right is None or (left is not None and first > second):
                below, first = first, left[1]
            else:
                below, second = second + 1, right[0]

    def _pair(self, first: int, second: int) -> bool:
        if len(self.pairs) >= PAIR_MEMO:
            self.older_pairs = self.pairs.copy()
            self.pairs.clear()
        known = self.older_pairs.get(first << 32 | second)
        if known is None:
            known = self._compatible(first, second)
        self.pairs[first << 32 | second] = known
        return known

    def _merge(self, piece: bytes) -> list[int]:
        lengths, shorter, pair = self.lengths, self.shorter, self.pairs.get
        longest: list[int | None] = [None] * (len(piece) + 1)
        for end, rank in self.automaton.iter(piece.decode("latin-1")):
            longest[end + 1 - lengths[rank]] = rank  # ends come in order, so the longest comes last
        useful = bytearray(b"\x01") * (len(piece) + 1)
        out: list[int] = []
        at, token, last = 0, longest[0], None
        while token is not None:
            while True:
                end = at + lengths[token]
                if useful[end]:
                    fits = last is None or pair(last << 32 | token)
                    if fits is None:
                        fits = self._pair(last, token)
                    if fits:
                        out.append(token)
                        at, last, token = end, token, longest[end]
                        break
                token = shorter[token]
                if token is None:
                    if last is None:
                        raise ValueError("the rank file does not cover all single bytes")
                    useful[at] = 0
                    token = out.pop()
                    at -= lengths[token]
                    last = out[-1] if out else None
                    break
        return out

    def _piece(self, piece: str) -> bytes:
        ids = self.older_pieces.get(piece)
        if ids is None:
            raw = piece.encode("utf-8")
            rank = self.ranks.get(raw)
            if rank is not None:
                ids = self.packed[rank]
            else:
                packed = self.packed
                ids = b"".join([packed[token] for token in self._merge(raw)])
            if len(raw) > PIECE_BYTES:
                return ids
        if len(self.pieces) >= PIECE_MEMO:
            self.older_pieces = self.pieces.copy()
            self.pieces.clear()
        self.pieces[piece] = ids
        return ids

    def encode(self, text: str) -> bytes:
        known, new = self.pieces.get, self._piece
        return b"".join([known(piece) or new(piece) for piece in self.findall(text)])

    def decode(self, ids: bytes) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[rank] for rank in np.frombuffer(ids, "<u4").tolist()])


_LOADED: dict[tuple[str, str], Tokenizer] = {}


def tokenizer(rank_path: str, pattern: str) -> Tokenizer:
    """The tokenizer of this worker process, built on first use."""
    key = (rank_path, pattern)
    if key not in _LOADED:
        _LOADED[key] = Tokenizer(rank_path, pattern)
    return _LOADED[key]


def encode(df: DataFrame, rank_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """Add the binary column ``ids``. ``rank_path`` is a file that every worker has."""

    def change() -> Callable:
        encoder = tokenizer(rank_path, pattern)
        return lambda value: encoder.encode(value) if value else b""

    return with_mapped(df, text, ids, "binary", change)


def decode(df: DataFrame, rank_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """Add the binary column ``decoded``: the UTF-8 bytes that ``ids`` stand for."""

    def change() -> Callable:
        encoder = tokenizer(rank_path, pattern)
        return lambda value: encoder.decode(value) if value else b""

    return with_mapped(df, ids, decoded, "binary", change)


def encode_and_decode(
    df: DataFrame,
    rank_path: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    sizes_only: bool = False,
) -> DataFrame:
    """Add ``ids`` and ``decoded`` in one pass: one worker and one tokenizer per task, where two passes take two.

    With ``sizes_only`` every text is decoded all the same, but ``decoded`` is the number of its bytes (long), and rows go
    on in portions of ``PORTION_ROWS``. Whole texts go on by batch: portions took more CPU time there.
    """
    kept = [name for name in df.columns if name not in (ids, decoded)]
    kind, arrow_kind = (T.LongType(), pa.int64()) if sizes_only else (T.BinaryType(), pa.binary())
    added = [T.StructField(ids, T.BinaryType()), T.StructField(decoded, kind)]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizer(rank_path, pattern)
        for whole in batches:
            step = PORTION_ROWS if sizes_only else max(1, whole.num_rows)
            for batch in (whole.slice(at, step) for at in range(0, whole.num_rows, step)):
                packed = [both.encode(value.as_py() or "") for value in batch.column(text)]
                texts = (both.decode(value) for value in packed)
                made = [pa.array(packed, pa.binary()), pa.array([len(t) if sizes_only else t for t in texts], arrow_kind)]
                yield pa.RecordBatch.from_arrays([*(batch.column(name) for name in kept), *made], [*kept, ids, decoded])
        give_back()

    return df.mapInArrow(rows, T.StructType([*(df.schema[name] for name in kept), *added]))

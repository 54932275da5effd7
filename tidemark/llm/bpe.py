"""Operator 11: byte-level BPE by a rank file, encoding and decoding, with no regex.

Every code point has a class. What a splitter does at a code point depends on its class and on what went before, so each
code point is a function from state to state, and composing functions is associative: blocks of code points are composed
side by side, the blocks' functions are scanned, and each block is then walked from the state it begins in. A token
boundary is a property of the pair (state before, class). The slices between boundaries are encoded once for each
distinct slice, by merging the pair of lowest rank until none is left, and kept; every token's end is kept as an offset
into the text's bytes, so that any range of tokens can be decoded to its place.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filled, segment_sum, text_slices

#: Classes of code points. BLANK is U+0020, SPACE all other white space.
OTHER, LETTER, NUMBER, SPACE, BLANK = range(5)
#: The code points with the property White_Space, without U+0020.
WHITE = (*range(0x09, 0x0E), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
#: What may follow an apostrophe to make a token of its own.
ENDINGS = ("s", "t", "m", "d"), ("re", "ve", "ll")

#: What a code point is to the splitter: white space in a run (WITHIN), the last of a run before something else, which is a
#: token alone (LAST) or joins what follows (LEAD), and apostrophes that may begin an ending of one or two letters.
SYMBOLS = LETTERS, NUMBERS, OTHERS, ENDING1, ENDING2, WITHIN, LAST, LEAD = range(8)
#: What the token so far is made of; AFTER: a token has just ended. REST1 and REST2: so many letters of an ending to come.
STATES = AFTER, IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACE, LEADING, REST1, REST2 = range(8)
FIRST = len(SYMBOLS)  # added to the symbol of a text's first code point
BLOCK = 256
TOKENS_AT_ONCE = 1 << 17  # decoded together
#: Distinct slices, and their bytes, that a worker keeps; beyond that it forgets them, which costs time and never changes ids.
MOST_SLICES, MOST_SLICE_BYTES = 600_000, 64 << 20


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """The next state, and whether a token begins here, for every (symbol, state before)."""
    begun = {LETTERS: IN_LETTERS, NUMBERS: IN_NUMBERS, OTHERS: IN_OTHERS, ENDING1: REST1, ENDING2: REST2, WITHIN: IN_SPACE, LAST: IN_SPACE, LEAD: LEADING}
    joins = {LETTERS: IN_LETTERS, NUMBERS: IN_NUMBERS, OTHERS: IN_OTHERS, ENDING1: IN_OTHERS, ENDING2: IN_OTHERS}  # apostrophes among other signs, or after a blank
    to, begins = np.zeros((2 * FIRST, len(STATES)), np.uint8), np.ones((2 * FIRST, len(STATES)), bool)
    for symbol in SYMBOLS:
        to[[symbol, symbol + FIRST]] = begun[symbol]
        for state in (IN_LETTERS, IN_NUMBERS, IN_OTHERS, LEADING):
            if symbol in joins and state in (joins[symbol], LEADING):
                to[symbol, state], begins[symbol, state] = joins[symbol], False
        to[symbol, REST2], begins[symbol, REST2] = REST1, False
        to[symbol, REST1], begins[symbol, REST1] = AFTER, False
    begins[WITHIN, IN_SPACE] = False
    return to, begins


NEXT, BEGINS = transitions()


@cache
def classes() -> np.ndarray:
    """The class of every code point."""
    of = {"L": LETTER, "N": NUMBER}
    out = np.fromiter((of.get(unicodedata.category(chr(c))[0], OTHER) for c in range(0x110000)), np.uint8, 0x110000)
    out[list(WHITE)] = SPACE
    out[0x20] = BLANK
    return out


def symbols(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The symbol of every code point; ``first`` marks those that begin a text."""
    n = len(points)
    kind = classes()[points]
    out = np.array([OTHERS, LETTERS, NUMBERS, WITHIN, WITHIN], np.uint8)[kind]
    white = kind >= SPACE
    before_other = np.zeros(n, bool)
    before_other[:-1] = white[:-1] & ~white[1:] & ~first[1:]
    out[before_other] = np.where(kind[before_other] == BLANK, LEAD, LAST)
    mark = np.flatnonzero(points == ord("'"))
    for endings, symbol in zip(ENDINGS, (ENDING1, ENDING2), strict=True):
        size = len(endings[0])
        at = mark[mark + size < n]
        for ending in endings:
            fits = np.ones(len(at), bool)
            for k, letter in enumerate(ending, 1):
                fits &= (points[at + k] == ord(letter)) & ~first[at + k]
            out[at[fits]] = symbol
    return out + FIRST * first.astype(np.uint8)


def states_before(symbol: np.ndarray) -> np.ndarray:
    """The state before every symbol, by an associative scan of their functions in blocks."""
    n = len(symbol)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:n] = symbol
    steps = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T).astype(np.intp) * len(STATES)
    table = NEXT.ravel()
    whole = np.repeat(np.arange(len(STATES), dtype=np.uint8)[:, None], blocks, axis=1)  # state before the block: state after it
    for row in steps:
        whole = table[row + whole]
    reach = 1
    while reach < blocks:  # whole[:, i] becomes the function of blocks 0 to i
        later = whole.copy()
        later[:, reach:] = np.take_along_axis(whole[:, reach:], whole[:, :-reach].astype(np.intp), axis=0)
        whole, reach = later, 2 * reach
    state = np.zeros(blocks, np.uint8)
    state[1:] = whole[AFTER, :-1]
    out = np.empty((BLOCK, blocks), np.uint8)
    for k, row in enumerate(steps):
        out[k] = state
        state = table[row + state]
    return out.T.ravel()[:n]


def slices(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The slices of all texts on end as binary values, and how many each text has."""
    texts = filled(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    raw = memoryview(raw)[ends[0] : ends[-1]] if raw is not None else memoryview(b"")
    points = np.frombuffer(str(raw, "utf-8").encode("utf-32-le"), np.uint32)
    if not len(points):
        return pa.array([], pa.large_binary()), np.zeros(len(texts), np.int64)
    width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
    start = np.cumsum(width) - width  # in bytes
    at = np.searchsorted(start, ends - ends[0])  # in code points
    first = np.zeros(len(points), bool)
    first[at[:-1][at[:-1] < len(points)]] = True
    symbol = symbols(points, first)
    begins = np.flatnonzero(BEGINS.ravel()[symbol.astype(np.intp) * len(STATES) + states_before(symbol)])
    offsets = np.append(start[begins], len(raw)).astype(np.int64)
    found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(raw)])
    return found, np.diff(np.searchsorted(begins, at))


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a slice: the adjacent pair of lowest rank, of equal ones the first, becomes one until no pair has a rank."""
    if piece in ranks:
        return [ranks[piece]]
    n = len(piece)
    end, before = list(range(1, n + 1)), list(range(-1, n))  # of the part that begins here; 0: none does
    queue = [(ranks[pair], i, i + 2) for i in range(n - 1) if (pair := piece[i : i + 2]) in ranks]
    heapq.heapify(queue)
    while queue:
        _, a, stop = heapq.heappop(queue)
        b = end[a]
        if not b or b >= n or end[b] != stop:
            continue  # one of its parts has been merged since
        end[a], end[b] = stop, 0
        if stop < n:
            before[stop] = a
            if (rank := ranks.get(piece[a : end[stop]])) is not None:
                heapq.heappush(queue, (rank, a, end[stop]))
        if a and (rank := ranks.get(piece[before[a] : stop])) is not None:
            heapq.heappush(queue, (rank, before[a], stop))
    out, a = [], 0
    while a < n:
        out.append(ranks[piece[a : end[a]]])
        a = end[a]
    return out


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indexes of all ranges on end."""
    total = np.cumsum(size)
    return np.repeat(start - total + size, size) + np.arange(total[-1] if len(total) else 0)


class Strings:
    """A byte string for each id; empty where there is none."""

    def __init__(self, values: list[bytes]):
        self.size = np.fromiter(map(len, values), np.int64, len(values))
        self.start = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(values), np.uint8)

    def join(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids on end."""
        parts = (ids[k : k + TOKENS_AT_ONCE] for k in range(0, len(ids), TOKENS_AT_ONCE))
        return np.concatenate([np.zeros(0, np.uint8), *(self.bytes[ranges(self.start[p], self.size[p])] for p in parts)])


class Codec:
    """Encodes and decodes by one rank file; keeps the ids of the slices it has met."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        if missing := [b for b in range(256) if bytes([b]) not in self.ranks]:
            raise ValueError(f"{len(missing)} single bytes have no rank")
        token = {rank: t for t, rank in self.ranks.items()}
        self.tokens = Strings([token.get(k, b"") for k in range(max(token) + 1)])
        self.decimals = Strings([b"%d " % k for k in range(max(token) + 1)])
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.held = 0
        self.at, self.n, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end, and how many each text has."""
        found, count = slices(texts)
        coded = found.dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        if len(self.known) > MOST_SLICES or self.held > MOST_SLICE_BYTES:
            self.forget()
        if new := [p for p in pieces if p not in self.known]:
            ids = [merged(p, self.ranks) for p in new]
            n = np.fromiter(map(len, ids), np.int64, len(ids))
            self.known.update(zip(new, range(len(self.n), len(self.n) + len(new)), strict=True))
            self.at = np.concatenate([self.at, len(self.ids) + np.cumsum(n) - n])
            self.n, self.ids = np.concatenate([self.n, n]), np.concatenate([self.ids, np.array([i for x in ids for i in x], np.int32)])
            self.held += sum(map(len, new))
        own = np.fromiter((self.known[p] for p in pieces), np.int64, len(pieces))[coded.indices.to_numpy(zero_copy_only=False)]
        return self.ids[ranges(self.at[own], self.n[own])], segment_sum(self.n[own], count)

    def sizes(self, ids: np.ndarray) -> np.ndarray:
        """Bytes of each token; an id that the rank file doesn't have is an error."""
        size = self.tokens.size
        if len(ids) and (ids.min() < 0 or ids.max() >= len(size) or not size[ids].all()):
            raise ValueError("an id is not in the rank file")
        return size[ids]

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all tokens on end."""
        self.sizes(ids)
        return self.tokens.join(ids)


@cache
def codec(path: str) -> Codec:
    """The worker's own codec for a rank file."""
    return Codec(path)


def default_ranks() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def lists(values: np.ndarray, count: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(count)]).astype(np.int32)), pa.array(values))


def encode(docs: DataFrame, ranks: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows key, ids, byte_ends: token ids of each whole text and where each token ends in the text's UTF-8 bytes.

    Every text is cut into letters, numbers, other signs and white space as the rank file's splitter does, and no string is
    special. ``ranks`` is a file of lines ``base64(token) rank`` with all 256 single bytes. A null or empty text has no
    tokens; a null key stays null; rows that repeat are encoded each; other columns are ignored. One pass, no shuffle.
    """
    path = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in text_slices(batch):
                ids, count = own.encode(part.column("text"))
                size = own.sizes(ids)
                before = np.repeat(np.concatenate([[0], np.cumsum(segment_sum(size, count))[:-1]]), count)
                yield pa.RecordBatch.from_arrays([part.column("key"), lists(ids, count), lists((np.cumsum(size) - before).astype(np.int32), count)], names=["key", "ids", "byte_ends"])

    return docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(run, "key long, ids array<int>, byte_ends array<int>")


def decode(tokens: DataFrame, ranks: str | None = None, into: str = "decoded") -> DataFrame:
    """All columns and the bytes of each row's whole list ``ids`` in ``into``, which replaces a column of that name.

    A null list is empty. An id that the rank file doesn't have, or that is null, is an error.
    """
    path = ranks or default_ranks()

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path)
        for batch in batches:
            ids = batch.flatten()
            if ids.null_count:
                raise ValueError("an id is null")
            ids = ids.to_numpy(zero_copy_only=False)
            count = batch.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.concatenate([[0], np.cumsum(segment_sum(own.sizes(ids), count))]).astype(np.int32)
            yield pa.BinaryArray.from_buffers(pa.binary(), len(batch), [None, pa.py_buffer(ends), pa.py_buffer(own.decode(ids))])

    return tokens.withColumn(into, run(F.col("ids").cast("array<int>")))


def token_span(tokens: DataFrame, first: int, last: int) -> DataFrame:
    """Rows key, start, decoded: the bytes of tokens ``first`` to ``last`` (exclusive) and the byte they start at.

    Only the wanted tokens are decoded; the place comes from the kept offsets. A text with fewer tokens gives what it has.
    """
    part = tokens.select("key", F.when(F.lit(first) > 0, F.coalesce(F.get("byte_ends", F.least(F.lit(first), F.size("byte_ends")) - 1), F.lit(0))).otherwise(0).alias("start"), F.slice("ids", first + 1, max(last - first, 0)).alias("ids"))
    return decode(part).select("key", "start", "decoded")


def hashes(raw: np.ndarray, size: np.ndarray, spare: int = 0) -> pa.Array:
    """sha256 in lowercase hex of each stretch of ``size`` bytes, without its last ``spare`` ones."""
    view, ends = memoryview(np.ascontiguousarray(raw)), np.concatenate([[0], np.cumsum(size)]).tolist()
    return pa.array([hashlib.sha256(view[a : max(b - spare, a)]).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.string())


def codec_digest(docs: DataFrame, ranks: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: doc_id, n_tokens, and hashes of the ids (decimal, joined by one space) and of the bytes they decode to.

    Ids are encoded, decoded and hashed where they arise, so neither ids nor decoded texts travel. Edge cases as ``encode``.
    """
    path = ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            for part in text_slices(batch):
                ids, count = own.encode(part.column("text"))
                decimals = hashes(own.decimals.join(ids), segment_sum(own.decimals.size[ids], count), 1)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(count), decimals, hashes(own.decode(ids), segment_sum(own.sizes(ids), count))], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

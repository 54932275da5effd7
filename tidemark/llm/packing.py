"""Operator 8: packing documents into sequences of a fixed length, best fit first, then swap-based local search.

Documents are encoded once; only lengths and checksums go on. Pieces are dealt in turn into groups of about
``GROUP_PIECES`` and each group is packed by itself, so work grows in proportion to the input, and splitting into
groups costs at most about one sequence in a group.
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage, text_slices
from tidemark.llm.tokens import default_tokenizer, encoder

GROUP_PIECES = 40_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_lengths(size: int, limit: int) -> list[int]:
    """Lengths of the pieces of a document of ``size`` ids: only the first may be shorter than the limit."""
    first = (size - 1) % limit + 1
    return [first, *[limit] * ((size - first) // limit)]


def cut_pieces(docs: DataFrame, tokenizer: str | None = None, limit: int = 1024, end_id: int = 2, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows doc_id, piece, start, length, ids_crc32. A null text is empty and has the end id alone."""
    path = tokenizer or default_tokenizer()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for part in text_slices(batch):
                ids, size = own.encode(part.column("text"))
                ends = np.cumsum(size + 1)
                full = np.empty(len(ids) + len(size), "<u4")
                full[ends - 1] = end_id
                full[np.repeat(np.arange(len(size)), size) + np.arange(len(ids))] = ids
                raw = memoryview(full.tobytes())
                rows = []
                for doc, a, n in zip(part.column("key").to_pylist(), (ends - size - 1).tolist(), (size + 1).tolist(), strict=True):
                    at = 0
                    for piece, length in enumerate(cut_lengths(n, limit)):
                        rows.append((doc, piece, at, length, zlib.crc32(raw[4 * (a + at) : 4 * (a + at + length)])))
                        at += length
                columns = list(zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(cut, PIECES)


def best_fit(sizes: np.ndarray, limit: int) -> list[list[int]]:
    """Bins of item numbers: largest first, each into the fullest bin that it fits."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(limit + 1)]
    there = 0  # bit g: some bin has a gap of g
    for item in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[item])
        fits = there >> size
        if fits:
            gap = size + (fits & -fits).bit_length() - 1
            at = by_gap[gap].pop()
            if not by_gap[gap]:
                there &= ~(1 << gap)
            bins[at].append(item)
        else:
            gap, at = limit, len(bins)
            bins.append([item])
        if left := gap - size:
            by_gap[left].append(at)
            there |= 1 << left
    return bins


class Search:
    """Local search over underfull bins: exchanges that raise the sum of squared fills, until bins empty.

    A bin takes an item from another one (move), one item for a smaller one (one for one) or two items of one bin for a
    smaller one (two for one), where it is then fuller than the other bin was. Of these the exchange that fills it most
    is taken, from the emptiest bin that offers it. Each exchange raises a bounded integer, so the search ends.
    """

    def __init__(self, bins: list[list[int]], sizes: np.ndarray, limit: int):
        self.size, self.limit, self.bins = sizes.tolist(), limit, bins
        self.fill = [sum(self.size[i] for i in b) for b in bins]
        self.full = sum(1 for b in bins if b)
        self.least = -(-sum(self.fill) // limit)
        self.version = [0] * len(bins)
        # for each size of an item, and each sum of two items, a heap of (fill, bin, version); bits say where heaps are
        self.heaps: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self.there = [0, 0]
        for b in range(len(bins)):
            self.offer(b)

    def offers(self, b: int) -> tuple[set[int], set[int]]:
        times = Counter(self.size[i] for i in self.bins[b])
        kinds = sorted(times)
        two = {x + y for n, x in enumerate(kinds) for y in kinds[n:] if x != y or times[x] > 1}
        return set(kinds), {t for t in two if t <= self.limit}

    def offer(self, b: int) -> None:
        """Lists what a bin has to give; what was listed of it before is stale."""
        self.version[b] += 1
        if not self.bins[b] or self.fill[b] >= self.limit:
            return
        for kind, wants in enumerate(self.offers(b)):
            for want in wants:
                heapq.heappush(self.heaps[kind].setdefault(want, []), (self.fill[b], b, self.version[b]))
                self.there[kind] |= 1 << want

    def donor(self, kind: int, want: int, into: int) -> int | None:
        """The emptiest bin but ``into`` that offers the wanted size."""
        heap, own, found = self.heaps[kind][want], None, None
        while heap and found is None:
            _, b, version = heap[0]
            if version != self.version[b]:
                heapq.heappop(heap)
            elif b == into:
                own = heapq.heappop(heap)
            else:
                found = b
        if own:
            heapq.heappush(heap, own)
        elif not heap:
            self.there[kind] &= ~(1 << want)
        return found

    def best(self, into: int) -> tuple[int, int, int, int] | None:
        """Donor, kind, size that comes and size that goes (0: none) of the exchange that fills a bin most."""
        gap = self.limit - self.fill[into]
        room, waiting = (1 << gap) - 1, []

        def wait(kind: int, out: int, below: int) -> None:
            bits = (self.there[kind] >> (out + 1)) & room & ((1 << below) - 1)
            if bits:
                heapq.heappush(waiting, (-bits.bit_length(), kind, out))

        for out in {self.size[i] for i in self.bins[into]} | {0}:
            for kind in (0, 1) if out else (0,):
                wait(kind, out, gap)
        while waiting:
            gain, kind, out = heapq.heappop(waiting)
            giver = self.donor(kind, out - gain, into)
            if giver is not None and self.fill[giver] < self.fill[into] - gain:
                return giver, kind, out - gain, out
            wait(kind, out, -gain - 1)
        return None

    def take(self, b: int, want: int) -> int:
        item = next(i for i in self.bins[b] if self.size[i] == want)
        self.bins[b].remove(item)
        return item

    def exchange(self, into: int, giver: int, kind: int, come: int, out: int) -> None:
        if kind:
            have = Counter(self.size[i] for i in self.bins[giver])
            one = next(x for x in have if have[come - x] > (1 if come == 2 * x else 0))
            got = [self.take(giver, one), self.take(giver, come - one)]
        else:
            got = [self.take(giver, come)]
        if out:
            self.bins[giver].append(self.take(into, out))
        self.bins[into] += got
        self.fill[into] += come - out
        self.fill[giver] -= come - out
        self.full -= not self.bins[giver]
        self.offer(into)
        self.offer(giver)

    def run(self) -> list[list[int]]:
        changed = True
        while changed and self.full > self.least:
            changed = False
            for into in sorted((b for b, f in enumerate(self.fill) if 0 < f < self.limit), key=lambda b: -self.fill[b]):
                while self.full > self.least and 0 < self.fill[into] < self.limit and (found := self.best(into)):
                    self.exchange(into, *found)
                    changed = True
        return [b for b in self.bins if b]


def improve(bins: list[list[int]], sizes: np.ndarray, limit: int) -> list[list[int]]:
    """The bins after local search; no more of them than before."""
    return Search(bins, sizes, limit).run()


def pack(pieces: DataFrame, limit: int = 1024, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Adds sequence_id and offset to pieces of at most ``limit``; pieces in a sequence stand without gaps from offset 0.

    Pieces are dealt to groups by their place in the written pieces, so groups are even however often a row repeats.
    """
    pieces = stage(pieces, "pieces")
    groups = max(1, round(pieces.count() / group_pieces))

    def fit(table: pa.Table) -> pa.Table:
        table = table.take(pc.sort_indices(table, [("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")]))
        sizes = table.column("length").to_numpy()
        bins = improve(best_fit(sizes, limit), sizes, limit)
        at = np.repeat(np.arange(len(bins)), [len(b) for b in bins]) + (table.column("group_id")[0].as_py() << 32)
        offset = np.concatenate([np.cumsum([0, *(int(sizes[i]) for i in b)])[:-1] for b in bins])
        return table.take(pa.array([i for b in bins for i in b])).drop_columns("group_id").append_column("sequence_id", pa.array(at)).append_column("offset", pa.array(offset))

    dealt = pieces.withColumn("group_id", F.pmod(F.monotonically_increasing_id(), F.lit(groups)))
    return dealt.groupBy("group_id").applyInArrow(fit, f"{PIECES}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str | None = None, limit: int = 1024, end_id: int = 2) -> DataFrame:
    """Pieces of all documents with their places. Empty input gives no rows; rows that repeat are packed each by itself."""
    return pack(cut_pieces(docs, tokenizer, limit, end_id), limit)


def packed_sequences(docs: DataFrame, placed: DataFrame, tokenizer: str | None = None, end_id: int = 2) -> DataFrame:
    """Rows sequence_id, doc_ids, ids: the token ids of each sequence, from documents and the places of their pieces.

    A sequence has at most the packing's limit of ids, so what is gathered for one is bounded. Ids of documents must
    differ, as pieces find their text by it.
    """
    path = tokenizer or default_tokenizer()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in batches:
            for part in text_slices(batch):
                ids, size = own.encode(part.column("text"))
                ends = np.cumsum(size + 1)
                full = np.empty(len(ids) + len(size), np.int32)
                full[ends - 1] = end_id
                full[np.repeat(np.arange(len(size)), size) + np.arange(len(ids))] = ids
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), pa.array(full))], names=["doc_id", "all"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(encode, "doc_id long, all array<int>")
    pieces = placed.join(rows, placed.doc_id.eqNullSafe(rows.doc_id)).select("sequence_id", "offset", placed.doc_id, F.slice("all", (F.col("start") + 1).cast("int"), F.col("length").cast("int")).alias("ids"))
    ordered = pieces.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("parts"))
    return ordered.select("sequence_id", F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"), F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids"))

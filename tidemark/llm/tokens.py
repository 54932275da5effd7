"""Token ids of whole texts with a public tokenizer, in bulk.

The tokenizer splits text into words and signs before it merges anything, and it always splits before a lone space,
around a lone line feed, and between a letter and the stops that end a piece. So a text is cut there, each distinct
piece is encoded once by the tokenizer, and numpy puts the ids together. Texts in which a space or line feed touches
other white space, and those that hold the string of an added token, are encoded whole. Either way the ids are those of
``Tokenizer.encode(text, add_special_tokens=False)``; a plain encoder reads the strings of special tokens as ordinary text.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tidemark.llm.common import filled, hashed, mixed, segment_sum

#: Most distinct pieces held by a worker; they are forgotten together beyond it, which costs time and never changes ids.
MOST_PIECES = 1_200_000
AT_ONCE = 8_000  # encodings in memory
SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BESIDE_SPACE = f"[ \n][{SPACES}]|[{SPACES}][ \n]"
LETTER = r"[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]"
STOPPED = rf"(?s)^(?P<stem>.*{LETTER})(?P<stop>[.,;:!?]+)$"
BARE, SPACED, BELOW = 0, 1, 2  # what stands before a piece: nothing, a space, a line feed


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """Encodes Arrow arrays of texts; keeps the ids of the pieces it has met, by a 64-bit hash."""

    def __init__(self, path: str, plain: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.added = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()})
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(0, np.uint64)  # ascending
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for i in range(0, len(texts), AT_ONCE) for e in self.tokenizer.encode_batch_fast(texts[i : i + AT_ONCE], add_special_tokens=False)]

    def places(self, words: pa.Array, before: np.ndarray) -> np.ndarray:
        """Where each distinct piece stands in the store; new pieces are encoded first."""
        if len(self.known) > MOST_PIECES:
            self.forget()
        key = mixed(hashed(words) ^ (before.astype(np.uint64) + np.uint64(1)))
        order = np.argsort(key)  # ascending keys are found faster
        at = np.empty(len(key), np.int64)
        at[order] = np.minimum(np.searchsorted(self.known, key[order]), max(len(self.known) - 1, 0))
        new = self.known[at] != key if len(self.known) else np.ones(len(key), bool)
        if new.any():
            fresh, first = np.unique(key[new], return_index=True)
            first = np.flatnonzero(new)[first]
            front = ("", " ", "\n")
            found = self.whole([front[b] + w for b, w in zip(before[first].tolist(), words.take(pa.array(first)).to_pylist(), strict=True)])
            length = np.fromiter(map(len, found), np.int64, len(found))
            start = len(self.ids) + np.cumsum(length) - length
            self.ids = np.concatenate([self.ids, np.array([i for ids in found for i in ids], np.uint32)])
            into = np.searchsorted(self.known, fresh)
            self.known, self.start, self.length = np.insert(self.known, into, fresh), np.insert(self.start, into, start), np.insert(self.length, into, length)
            at[order] = np.searchsorted(self.known, key[order])
        return at

    def cut(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        count = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * 2 + 1
        code[np.cumsum(count) - count] -= 1  # the first piece of a text has nothing before it
        slots = np.zeros(2 * len(coded.dictionary), bool)
        slots[code] = True
        used = np.flatnonzero(slots)
        slot = np.cumsum(slots) - 1
        words = coded.dictionary.take(pa.array(used >> 1))
        below = pc.starts_with(words, "\n").to_numpy(zero_copy_only=False)
        before = np.where(below, BELOW, used & 1)
        words = pc.if_else(pa.array(below), pc.utf8_slice_codeunits(words, 1), words)
        parts = pc.extract_regex(words, STOPPED)
        stopped = pc.is_valid(parts).to_numpy(zero_copy_only=False)
        stems = pc.if_else(pa.array(stopped), pc.struct_field(parts, 0), words)
        stops = pc.struct_field(parts, 1).filter(pa.array(stopped)).dictionary_encode()
        at = self.places(pa.concat_arrays([stems, stops.dictionary]), np.concatenate([before, np.zeros(len(stops.dictionary), np.int64)]))
        stem, stop = at[: len(stems)], at[len(stems) :][stops.indices.to_numpy(zero_copy_only=False)]
        # ids of each distinct piece: those of its stem, then those of its stop
        pieces = np.zeros(len(used) + len(stop), np.int64)
        place = np.arange(len(used)) + np.cumsum(stopped) - stopped
        pieces[place] = stem
        pieces[place[stopped] + 1] = stop
        table, n = self.gather(pieces)
        size = segment_sum(n, 1 + stopped.astype(np.int64))
        start = np.cumsum(size) - size
        at = slot[code]
        n = size[at]
        total = np.cumsum(n)
        ids = table[np.repeat(start[at] - total + n, n) + np.arange(total[-1] if len(total) else 0)]
        return ids, segment_sum(n, count)

    def gather(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = self.length[at]
        total = np.cumsum(n)
        return self.ids[np.repeat(self.start[at] - total + n, n) + np.arange(total[-1] if len(total) else 0)], n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts on end (uint32), and how many each text has. A null text is empty and has none."""
        texts = filled(texts)
        odd = pc.match_substring_regex(texts, BESIDE_SPACE).to_numpy(zero_copy_only=False)
        for content in self.added:
            odd = odd | pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not odd.any():
            return self.cut(texts) if len(texts) else (np.zeros(0, np.uint32), np.zeros(0, np.int64))
        size = np.zeros(len(texts), np.int64)
        slow = [np.array(x, np.uint32) for x in self.whole(texts.filter(pa.array(odd)).to_pylist())]
        size[odd] = [len(x) for x in slow]
        fast = np.zeros(0, np.uint32)
        if not odd.all():
            fast, size[~odd] = self.cut(texts.filter(pa.array(~odd)))
        ids = np.empty(size.sum(), np.uint32)
        ids[np.repeat(~odd, size)] = fast
        ids[np.repeat(odd, size)] = np.concatenate(slow)
        return ids, size


_encoders: dict[tuple[str, bool], Encoder] = {}


def encoder(path: str, plain: bool = False) -> Encoder:
    """The worker's own encoder for a tokenizer file."""
    if (path, plain) not in _encoders:
        _encoders[path, plain] = Encoder(path, plain)
    return _encoders[path, plain]

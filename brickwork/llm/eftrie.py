"""An n-gram trie in Elias-Fano levels, in files that workers map into memory.

A level holds, for each context (an n-gram of the level above, by its index), the words that follow.
Context and word make one monotone key; keys are Elias-Fano coded, so that the contexts' pointers
and their words are one sequence, in which a word is sought relative to its context: the high bits
give a short range, in which the successor of the low bits is the word or shows that it is missing.
With each n-gram goes its quantised probability, with each context its quantised back-off weight.

A level is cut by ranges of contexts into shards, one file each; level one, the words by their hashes in
monotone order, by ranges of hashes. Files of a local (or mounted) folder are mapped into memory; of any
other store a worker holds HELD bytes of shards at most, those that it used last.
"""

from __future__ import annotations

import json
import uuid
from collections import OrderedDict
from dataclasses import dataclass

import numpy as np
from pyarrow import fs

U = np.uint64
#: Log10 range of the quantised values; 255 steps.
SPAN = 10.0


def quantise(p: np.ndarray) -> np.ndarray:
    return np.rint(np.clip(-np.log10(np.maximum(p, 1e-300)) / SPAN, 0, 1) * 254).astype(np.uint8)


CODE = np.append(10.0 ** (-np.arange(255) * SPAN / 254), 0.0)
NONE = 255  # the code of a context without words


def write(uri: str, name: str, arrays: dict[str, np.ndarray], **numbers: int) -> None:
    """One file: a JSON line of places and numbers, then the arrays. Written aside and moved, so a repeated task is harmless."""
    system, path = fs.FileSystem.from_uri(uri)
    head, at = {}, 0
    for k, a in arrays.items():
        head[k] = (a.dtype.str, len(a), at)
        at += -(-a.nbytes // 8) * 8
    line = json.dumps({"arrays": head, **numbers}).encode()
    line += b" " * (-(len(line) + 1) % 8) + b"\n"
    aside = f"{path}/.{name}-{uuid.uuid4().hex}"
    with system.open_output_stream(aside) as out:
        out.write(line)
        for a in arrays.values():
            out.write(a.tobytes() + b"\0" * (-a.nbytes % 8))
    system.move(aside, f"{path}/{name}")


#: Bytes of shards that a worker keeps where files can't be mapped.
HELD = 256 << 20


class Shards:
    """The files of one level, opened when they are asked for."""

    def __init__(self, uri: str, name: str, sizes: list[int]):
        self.system, self.path = fs.FileSystem.from_uri(uri)
        self.name, self.sizes = name, sizes
        self.mapped = isinstance(self.system, fs.LocalFileSystem)
        self.open: OrderedDict[int, tuple[dict, int]] = OrderedDict()

    def get(self, s: int) -> dict | None:
        """The arrays and numbers of shard s, and its Sequence; None if it is empty."""
        if not self.sizes[s]:
            return None
        if s in self.open:
            self.open.move_to_end(s)
            return self.open[s][0]
        path = f"{self.path}/{self.name}-{s}"
        if self.mapped:
            raw = np.memmap(path, np.uint8, "r").view(np.ndarray)
        else:
            with self.system.open_input_file(path) as f:
                raw = np.frombuffer(f.read(), np.uint8)
        size = int(np.argmax(raw[: 1 << 16] == 10)) + 1
        head = json.loads(raw[:size].tobytes())
        part = {k: raw[size + at : size + at + n * np.dtype(t).itemsize].view(t) for k, (t, n, at) in head.pop("arrays").items()} | head
        part["code"] = Sequence(part, part["n"], part["bits"])
        self.open[s] = part, len(raw)
        while not self.mapped and len(self.open) > 1 and sum(n for _, n in self.open.values()) > HELD:
            self.open.popitem(last=False)
        return part


def encode(keys: np.ndarray, universe: int) -> tuple[dict[str, np.ndarray], int]:
    """Elias-Fano arrays of sorted distinct keys below universe, and the number of low bits."""
    n = len(keys)
    low = max(0, (universe // max(n, 1)).bit_length() - 1)
    high = (keys >> U(low)).astype(np.int64)
    buckets = (universe >> low) + 1
    bits = np.zeros(-(-(n + buckets) // 64) * 64, np.uint8)
    bits[high + np.arange(n)] = 1
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    ones = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]]).astype(np.uint32 if n < 2**32 else np.int64)
    packed = np.zeros(n * low // 64 + 2, np.uint64)
    if low:
        part = keys & U((1 << low) - 1)
        place = np.arange(n, dtype=np.int64) * low
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        np.bitwise_or.at(packed, word, part << shift)
        over = (shift + U(low)) > U(64)
        np.bitwise_or.at(packed, word[over] + 1, part[over] >> (U(64) - shift[over]))
    return {"high": words, "ones": ones, "low": packed}, low


class Sequence:
    """Successor search in an Elias-Fano coded sequence."""

    def __init__(self, arrays: dict, n: int, low: int):
        self.words, self.packed, self.n, self.low = arrays["high"], arrays["low"], n, low
        self.zeros = np.arange(len(self.words), dtype=np.int64) * 64 - arrays["ones"].astype(np.int64)

    def select0(self, j: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.zeros, j, "right") - 1
        x, left = ~self.words[word], j - self.zeros[word]
        place = word * 64
        for step in (32, 16, 8, 4, 2, 1):
            count = np.bitwise_count(x & U((1 << step) - 1)).astype(np.int64)
            on = left >= count
            place = place + on * step
            left = left - on * count
            x = np.where(on, x >> U(step), x)
        return place

    def lows(self, i: np.ndarray) -> np.ndarray:
        place = i * self.low
        word, shift = place >> 6, (place & 63).astype(np.uint64)
        first = self.packed[word] >> shift
        second = np.where(shift > 0, self.packed[word + 1] << (U(64) - np.maximum(shift, U(1))), U(0))
        return (first | second) & U((1 << self.low) - 1)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The rank of each key, -1 where it is missing."""
        if not self.n or not len(keys):
            return np.full(len(keys), -1)
        high = (keys >> U(self.low)).astype(np.int64)
        end = self.select0(high) - high
        begin = np.where(high > 0, self.select0(np.maximum(high - 1, 0)) - np.maximum(high - 1, 0), 0)
        if not self.low:
            return np.where(end > begin, begin, -1)
        want = keys & U((1 << self.low) - 1)
        a, b = begin.copy(), end.copy()
        open_ = np.flatnonzero(a < b)
        while len(open_):  # the first in the range that is not below
            mid = (a[open_] + b[open_]) >> 1
            below = self.lows(mid) < want[open_]
            a[open_] = np.where(below, mid + 1, a[open_])
            b[open_] = np.where(below, b[open_], mid)
            open_ = open_[a[open_] < b[open_]]
        hit = a < end
        hit[hit] = self.lows(a[hit]) == want[hit]
        return np.where(hit, a, -1)


@dataclass
class Vocabulary:
    """Level one: Elias-Fano coded 64-bit word hashes and their counts, in shards by the hash's leading bits."""

    uri: str
    sizes: list[int]
    total: int

    def open(self) -> Vocabulary:
        self.parts = Shards(self.uri, "words", self.sizes)
        self.offset = np.concatenate([[0], np.cumsum(self.sizes)])
        self.size = int(self.offset[-1])
        return self

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index and count of each hash; -1 and 0 if unknown."""
        some, inverse = np.unique(hashes, return_inverse=True)
        index, count = np.full(len(some), -1), np.zeros(len(some), np.int64)
        shard = shard_of(some, len(self.sizes))
        edge = np.searchsorted(shard, np.arange(len(self.sizes) + 1))
        for s in np.flatnonzero(np.diff(edge)).tolist():
            a, b = edge[s], edge[s + 1]
            if (part := self.parts.get(s)) is None:
                continue
            rank = part["code"].find(some[a:b] - U(shard_start(s, len(self.sizes))))
            index[a:b] = np.where(rank >= 0, rank + self.offset[s], -1)
            count[a:b] = np.where(rank >= 0, part["count"][np.maximum(rank, 0)], 0)
        return index[inverse], count[inverse]


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes >> U(32)) * U(shards) >> U(32)).astype(np.int64)


def shard_start(s: int, shards: int) -> int:
    """The least hash of a shard."""
    return -(-(s << 32) // shards) << 32


def build_words(uri: str, s: int, shards: int, hashes: np.ndarray, counts: np.ndarray) -> None:
    """Writes one shard of level one from sorted distinct hashes and counts."""
    start = shard_start(s, shards)
    arrays, low = encode(hashes - U(start), shard_start(s + 1, shards) - start)
    write(uri, f"words-{s}", arrays | {"count": counts}, n=len(hashes), bits=low)


@dataclass
class Level:
    """n-grams below `contexts` contexts, cut into shards of `width` contexts."""

    uri: str
    name: str
    words: int
    contexts: int
    width: int
    sizes: list[int]

    def open(self) -> Level:
        self.parts = Shards(self.uri, self.name, self.sizes)
        self.offset = np.concatenate([[0], np.cumsum(self.sizes)])
        return self

    def find(self, context: np.ndarray, word: np.ndarray, values: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index (-1 if missing), share and back-off weight (1 if the context has no words) of each pair; -1 is no context, no word."""
        index, share, weight = np.full(len(context), -1), np.zeros(len(context)), np.ones(len(context))
        known = np.flatnonzero(context >= 0)
        if not len(known) or not len(self.sizes):
            return index, share, weight
        shard = context[known] // self.width
        local = (context[known] - shard * self.width).astype(np.uint64)
        key = local * U(self.words + 1) + np.where(word[known] < 0, self.words, word[known]).astype(np.uint64)
        # contexts in order are shards in order, so that one number sorts by both where it fits
        if self.contexts * (self.words + 1) < 2**64:
            order = np.argsort(context[known].astype(np.uint64) * U(self.words + 1) + (key - local * U(self.words + 1)))
        else:
            order = np.lexsort((key, shard))
        known, shard, local, key = known[order], shard[order], local[order], key[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (shard[1:] != shard[:-1])
        at = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        i_, s_, w_ = np.full(len(first), -1), np.zeros(len(first)), np.ones(len(first))
        edge = np.searchsorted(shard[first], np.arange(len(self.sizes) + 1))
        for s in np.flatnonzero(np.diff(edge)).tolist():
            a, b = edge[s], edge[s + 1]
            if (part := self.parts.get(s)) is None:
                continue
            rank = part["code"].find(key[first[a:b]])
            i_[a:b] = np.where(rank >= 0, rank + self.offset[s], -1)
            if values:
                s_[a:b] = np.where(rank >= 0, CODE[part["share"][np.maximum(rank, 0)]], 0)
                back = part["back"][local[first[a:b]].astype(np.int64)]
                w_[a:b] = np.where(back == NONE, 1.0, CODE[back])
        index[known], share[known], weight[known] = i_[at], s_[at], w_[at]
        return index, share, weight


def build_shard(uri: str, name: str, keys: np.ndarray, counts: np.ndarray, words: int, width: int, discount: float) -> None:
    """Writes one shard from sorted distinct keys (local context * (words + 1) + word) and counts."""
    context = (keys // U(words + 1)).astype(np.int64)
    total = np.bincount(context, weights=counts, minlength=width)
    kinds = np.bincount(context, minlength=width)
    share = quantise((counts - discount) / total[context])
    with np.errstate(invalid="ignore", divide="ignore"):
        back = np.where(kinds > 0, quantise(discount * kinds / total), NONE).astype(np.uint8)
    arrays, low = encode(keys, width * (words + 1))
    write(uri, name, arrays | {"share": share, "back": back}, n=len(keys), bits=low)

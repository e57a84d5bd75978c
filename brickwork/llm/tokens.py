"""Token ids of whole texts, with each distinct space-led word encoded once per worker.

The byte-level BPE splits a text before it merges, and never merges over a split. A word
`[^\\x20\\x09-\\x0D]+` with the one space before it, and what else lies between words, are therefore
encoded alone. Texts with other white space (no-break space and the like) are encoded whole.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from brickwork.llm import common as C

_OTHER_SPACE = re.compile("[" + "".join(map(chr, [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])) + "]")
#: Words a worker remembers. Beyond, it forgets and starts anew; results don't depend on it.
REMEMBERED = 400_000
#: Bytes of a word from which on `tokenizers` merges it, whose time doesn't grow with its square.
LONG_WORD = 512


_EDGE = re.compile(r"(?<=\S)[\x20\x09-\x0D]")


def _cut(text: str, limit: int) -> Iterator[str]:
    """Parts of a long text, each ending with a word before white space, where the encoding splits it anyway."""
    at = 0
    while at < len(text):
        edge = _EDGE.search(text, at + limit)
        to = edge.start() if edge else len(text)
        yield text[at:to]
        at = to


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = True
    return found


def merger(vocabulary: dict[str, int]):
    """The same vocabulary in tiktoken, which merges new words faster; a byte-level BPE's ids are its ranks."""
    import public_tokenizers
    import tiktoken

    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    ranks = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if not token.startswith("<|")}
    return tiktoken.Encoding("same", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """ids(column) gives (counts of tokens of each row, all ids in order)."""

    def __init__(self, path: str):
        self.tokenizer = load(path)
        vocabulary = self.tokenizer.get_vocab()
        self.bytes = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():  # in byte-level BPE a character of a token is a byte
            self.bytes[i] = len(token)
        self.merger = merger(vocabulary)
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at = np.zeros(0, np.int64)
        self.size = np.zeros(0, np.int64)
        self.recent: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.fresh = 0
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.gaps: dict[bytes, np.ndarray] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _put(self, ids: np.ndarray) -> int:
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(len(self.pool), np.uint32)])
        at = self.used
        self.pool[at : at + len(ids)] = ids
        self.used += len(ids)
        return at

    def _learn(self, keys: np.ndarray, words: list[bytes], led: np.ndarray) -> None:
        """Encodes new words as one text: a token's bytes tell which word it belongs to. Very long words go alone."""
        if big := [i for i, x in enumerate(words) if len(x) > LONG_WORD]:
            for i in big:
                ids = np.array(self.encode([(" " if led[i] else "") + words[i].decode()])[0], np.uint32)
                self.recent.append((keys[i : i + 1], np.array([self._put(ids)]), np.array([len(ids)])))
            rest = np.array([len(x) <= LONG_WORD for x in words])
            keys, words, led = keys[rest], [x for x in words if len(x) <= LONG_WORD], led[rest]
            if not words:
                return
        text = b"".join((b" " if s else b"\n") + x for x, s in zip(words, led.tolist(), strict=True))
        ids = self.merger.encode_to_numpy(text.decode(), disallowed_special=()).astype(np.int64)
        length = np.fromiter(map(len, words), np.int64, len(words)) + 1
        ends = np.cumsum(length)
        word = np.searchsorted(ends, np.cumsum(self.bytes[ids]), "left")
        newline = np.zeros(len(ids), bool)  # the one that stands before a word that no space leads
        newline[np.flatnonzero(np.diff(word, prepend=-1) > 0)] = True
        keep = ~(newline & ~led[word])
        ids, word = ids[keep], word[keep]
        size = np.bincount(word, minlength=len(words))
        at = self._put(ids.astype(np.uint32)) + np.cumsum(size) - size
        self.recent.append((keys, at, size))
        self.fresh += len(keys)
        if self.fresh > len(self.keys) // 4:
            parts = [(self.keys, self.at, self.size), *self.recent]
            keys, at, size = (np.concatenate([x[i] for x in parts]) for i in range(3))
            order = np.argsort(keys, kind="stable")
            self.keys, self.at, self.size, self.recent, self.fresh = keys[order], at[order], size[order], [], 0

    def _find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of each key's ids; -1 where unknown."""
        at, size = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        for known, a, s in [(self.keys, self.at, self.size), *self.recent]:
            if len(known):
                i = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = known[i] == keys
                at[hit], size[hit] = a[i[hit]], s[i[hit]]
        return at, size

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(column) == 1 and len(text := column[0].as_py() or "") > C.SLICE_BYTES:
            found = [self._ids(pa.array([x]))[1] for x in _cut(text, C.SLICE_BYTES)]
            return np.array([sum(map(len, found))], np.int64), np.concatenate(found)
        return self._ids(column)

    def _ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = [i for i, x in enumerate(C.strings(column)) if _OTHER_SPACE.search(x)]
        w = C.Words(column)
        led = np.zeros(len(w.start), bool)  # one space before it, in the same document
        begins = np.zeros(len(w.start), bool)
        begins[w.first[:-1][w.count > 0]] = True
        doc_start = np.repeat(w.ends[:-1], w.count)
        inside = w.start > doc_start
        led[inside] = w.data[w.start[inside] - 1] == 0x20
        # what lies between: from the end of the last word to this one's start, without the led space
        gap_from = np.concatenate([[0], w.end[:-1]]) if len(w.end) else np.zeros(0, np.int64)
        gap_from = np.where(begins, doc_start, gap_from)
        gap_to = w.start - led
        keys = C.mix(w.hash ^ np.where(led, np.uint64(0x5851F42D4C957F2D), np.uint64(0)))
        some, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.forget()
        at, size = self._find(some)
        if (new := at < 0).any():
            raw, j = w.data.tobytes(), first[new]
            self._learn(some[new], [raw[a:b] for a, b in zip(w.start[j].tolist(), w.end[j].tolist(), strict=True)], led[j])
            at, size = self._find(some)
        at, size = at[inverse], size[inverse]
        doc = w.doc()
        order = None
        more = np.flatnonzero(gap_to > gap_from)
        last = np.where(w.count > 0, w.end[np.maximum(w.first[1:] - 1, 0)] if len(w.end) else 0, w.ends[:-1])
        tails = np.flatnonzero(w.ends[1:] > last)
        if len(more) or len(tails):
            g_at, g_size, g_doc, g_place = [], [], [], []
            raw = w.data.tobytes()
            for k in more.tolist():
                a, s = self._gap(raw[gap_from[k] : gap_to[k]], bool(led[k]))
                g_at.append(a), g_size.append(s), g_doc.append(doc[k]), g_place.append(2 * k)
            for d in tails.tolist():
                a, s = self._gap(raw[last[d] : w.ends[d + 1]], None)
                g_at.append(a), g_size.append(s), g_doc.append(d), g_place.append(2 * w.first[d + 1] - 1 + 0.5)
            where = np.concatenate([2.0 * np.arange(len(at)) + 0.25, np.array(g_place, float)])
            order = np.argsort(where, kind="stable")
            at = np.concatenate([at, np.array(g_at, np.int64)])[order]
            size = np.concatenate([size, np.array(g_size, np.int64)])[order]
            doc = np.concatenate([doc, np.array(g_doc, np.int64)])[order]
        counts = np.bincount(doc, weights=size, minlength=len(w.count)).astype(np.int64)
        ends = np.cumsum(size)
        ids = self.pool[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(at - ends + size, size)]
        if whole:
            parts, edge = [], np.concatenate([[0], np.cumsum(counts)])
            known = dict(zip(whole, self.encode([column[i].as_py() for i in whole]), strict=True))
            for d in range(len(counts)):
                parts.append(np.array(known[d], np.uint32) if d in known else ids[edge[d] : edge[d + 1]])
            counts = np.array([len(x) for x in parts], np.int64)
            ids = np.concatenate(parts)
        return counts, ids

    def _gap(self, raw: bytes, led: bool | None) -> tuple[int, int]:
        """White space before a word that a space leads (True) or not (False), or at a text's end (None)."""
        key = raw + (b"" if led is None else b"1" if led else b"0")
        if key not in self.gaps:
            text = raw.decode()
            parts = [text] if led is None or led or len(text) == 1 else [text[:-1], text[-1:]]
            ids = np.array([i for x in self.encode(parts) for i in x], np.uint32)
            self.gaps[key] = np.array([self._put(ids), len(ids)])
        a, s = self.gaps[key]
        return int(a), int(s)

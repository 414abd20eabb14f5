"""Token ids by the tokenizers library, with a memory of the pieces of text it has met.

Tokenizers work on pre-tokens that don't depend on each other, so a text is cut where no pre-token
crosses, each distinct piece is encoded by the library once per worker and bounded memory, and
ids are put together from there. Many texts are cut, hashed and looked up at once, in arrays; the memory holds
64-bit hashes, not the pieces.

Two kinds of tokenizer are known: those that drop white space and lower-case (cut at white space) and byte-level ones
whose pre-tokens take one space before a word (cut before single spaces, and around single line ends). Both are also
cut before a full stop or comma that ends a word. What lies between two cuts goes to the library as it is, so the result
always equals `Tokenizer.encode(text, add_special_tokens=False).ids`; texts with white space beyond ASCII, or with a part
of a special token, go there whole.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np

from tastecore.llm.shingles import byte_values, mixed, power

REMEMBERED = 1_000_000  # distinct pieces, about 50 bytes each
BLOCK_BYTES = 1 << 18
WIDE_SPACE = re.compile("[\x85\xa0  -     　]")
SAFE_CUT = re.compile(rb"[A-Za-z0-9] [A-Za-z0-9]")  # in a long text: before the space
BORDER = 0xFF  # between texts: a byte that UTF-8 does not have

_is_space = np.zeros(256, bool)
_is_space[[32, *range(9, 14)]] = True
_ends = _is_space.copy()
_ends[BORDER] = True
_is_word = np.zeros(256, bool)
_is_word[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True
_is_stop = np.zeros(256, bool)
_is_stop[[ord("."), ord(",")]] = True


class _Places:
    """An open-addressing table from hashes to places, for arrays of hashes. It grows with them, at most 5/8 full."""

    def __init__(self) -> None:
        self._resize(1 << 16)

    def _resize(self, size: int) -> None:
        self.size, self.filled = size, 0
        self.keys = np.zeros(size, np.uint64)
        self.places = np.zeros(size, np.int32)
        self.mask = np.uint64(size - 1)

    def clear(self) -> None:
        self.filled = 0
        self.keys[:] = 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 if it isn't there."""
        found = np.full(len(keys), -1, np.int32)
        slots, open_ = (keys & self.mask).astype(np.int64), np.arange(len(keys))
        while len(open_):
            there = self.keys[slots[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self.places[slots[open_[hit]]]
            open_ = open_[~hit & (there != 0)]
            slots[open_] = (slots[open_] + 1) & int(self.mask)
        return found

    def put(self, keys: np.ndarray, places: np.ndarray) -> None:
        """Different keys, none of them there yet."""
        size = self.size
        while 8 * (self.filled + len(keys)) > 5 * size:
            size *= 2
        if size > self.size:
            there = self.keys != 0
            held = self.keys[there], self.places[there]
            self._resize(size)
            self.put(*held)
        self.filled += len(keys)
        slots, open_ = (keys & self.mask).astype(np.int64), np.arange(len(keys))
        while len(open_):
            free = self.keys[slots[open_]] == 0
            _, first = np.unique(slots[open_[free]], return_index=True)
            now = open_[free][first]
            self.keys[slots[now]], self.places[slots[now]] = keys[now], places[now]
            open_ = np.setdiff1d(open_, now, assume_unique=True)
            slots[open_] = (slots[open_] + (self.keys[slots[open_]] != 0)) & int(self.mask)


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        self.drops_space = (described["pre_tokenizer"] or {}).get("type") == "Sequence"
        self.special = sorted({t["content"][:2] for t in described["added_tokens"]})
        self.values = byte_values(fold=self.drops_space)
        vocabulary, suffix = self.tokenizer.get_vocab(), described["model"].get("end_of_word_suffix") or None
        self.marks = np.zeros(max(vocabulary.values()) + 1, bool)
        space = "\u0120"  # how byte-level vocabularies write a space
        marked = [i for t, i in vocabulary.items() if (suffix and t.endswith(suffix) if self.drops_space else t.startswith(space))]
        self.marks[marked] = True
        self.known = _Places()
        self._forget()

    def _forget(self) -> None:
        self.known.clear()
        self.starts = np.zeros(1024, np.int64)
        self.lengths = np.zeros(1024, np.int32)
        self.ids = np.zeros(4096, np.uint32)
        self.used = self.count = 0

    def _encoded(self, pieces: Sequence[str]) -> list[list[int]]:
        batch = self.tokenizer.encode_batch_fast(list(pieces), add_special_tokens=False)
        return [e.ids for e in batch]

    def _encoded_words(self, words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sizes, and ids one after the other, of pieces that are one pre-token each also side by side: a single call.

        The ids themselves say where a word ends or begins: by the suffix of a word's last token, or the space of its first.
        """
        (found,) = self._encoded([(" " if self.drops_space else "").join(words)])
        ids = np.array(found, np.uint32)
        marked = np.flatnonzero(self.marks[ids])
        limits = np.concatenate(([0], marked + 1)) if self.drops_space else np.append(marked, len(ids))
        if len(limits) != len(words) + 1 or limits[0] != 0 or limits[-1] != len(ids):
            raise ValueError("this vocabulary does not mark its words")
        return np.diff(limits), ids

    def _is_word(self, piece: str) -> bool:
        """Latin letters only, whose lower case is one letter: a pre-token that no normalising changes."""
        word = piece if self.drops_space else piece[1:] if piece[0] == " " else ""
        return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and "\u0130" not in word))

    def _whole(self, text: str) -> bool:
        """Whether the cuts can't be seen from single bytes."""
        return any(s in text for s in self.special) or not self.drops_space and not text.isascii() and WIDE_SPACE.search(text) is not None

    def _pieces(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces; `data` begins and ends with BORDER, which stands between texts too."""
        cut = np.zeros(len(data) + 1, bool)
        space, ends = _is_space[data], _ends[data]
        cut[1:-2] = _is_stop[data[1:-1]] & _is_word[data[:-2]] & ends[2:]
        if self.drops_space:
            inside = ~ends
            cut[1:-1] |= inside[1:] & ~inside[:-1]
            starts = np.flatnonzero(cut[:-1] & inside)
            cut[1:-1] |= inside[:-1] & ~inside[1:]
            limits = np.flatnonzero(cut)
            return starts, limits[np.searchsorted(limits, starts, side="right")]
        single = np.zeros(len(data), bool)
        single[1:-1] = space[1:-1] & ~ends[:-2] & ~ends[2:]
        line = single & (data == 10)
        cut[:-1] |= (single & (data == 32)) | line
        cut[1:] |= line
        border = data == BORDER
        cut[:-1] |= border
        cut[1:] |= border
        limits = np.flatnonzero(cut)
        starts = limits[:-1][~border[limits[:-1]]]
        return starts, limits[np.searchsorted(limits, starts, side="right")]

    def _learn(self, data: bytes, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places of pieces that are new; the same piece may come several times."""
        fresh, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        pieces = [data[s:e].decode("utf-8") for s, e in zip(starts[first].tolist(), ends[first].tolist())]
        word = np.fromiter(map(self._is_word, pieces), bool, len(pieces))
        order = np.argsort(~word, kind="stable")
        sizes, ids = self._encoded_words([p for p, w in zip(pieces, word) if w]) if word.any() else (np.empty(0, np.int64), np.empty(0, np.uint32))
        if not word.all():
            found = self._encoded([p for p, w in zip(pieces, word) if not w])
            sizes = np.concatenate((sizes, np.fromiter(map(len, found), np.int64, len(found))))
            ids = np.concatenate((ids, np.fromiter(chain.from_iterable(found), np.uint32)))
        total, begin, end = len(ids), self.count, self.count + len(pieces)
        for name, need in (("starts", end), ("lengths", end), ("ids", self.used + total)):
            held = getattr(self, name)
            if need > len(held):
                setattr(self, name, np.concatenate((held, np.zeros(max(need, 2 * len(held)) - len(held), held.dtype))))
        self.lengths[begin:end] = sizes
        self.starts[begin:end] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used : self.used + total] = ids
        places = np.empty(len(pieces), np.int32)
        places[order] = np.arange(begin, end)
        self.known.put(fresh, places)
        self.count, self.used = end, self.used + total
        return places[inverse]

    def _ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text, or part of one."""
        border = bytes([BORDER])
        joined = border + border.join(texts) + border
        data = np.frombuffer(joined, np.uint8)
        starts, ends = self._pieces(data)
        sums = np.concatenate(([np.uint64(0)], np.cumsum(self.values[data] * power("up", len(data))[: len(data)], dtype=np.uint64)))
        keys = mixed((sums[ends] - sums[starts]) * power("down", len(data))[starts])
        keys[keys == 0] = 1
        if self.count > REMEMBERED:
            self._forget()
        at = self.known.find(keys)
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = self._learn(joined, keys[new], starts[new], ends[new])
        sizes = self.lengths[at].astype(np.int64)
        done = np.cumsum(sizes)
        total = int(done[-1]) if len(done) else 0
        ids = self.ids[np.arange(total) + np.repeat(self.starts[at] - done + sizes, sizes)]
        limits = np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))
        return np.split(ids, np.concatenate(([0], done))[limits[:-1]])

    def encode(self, texts: Sequence[str | None]) -> Iterator[np.ndarray]:
        """The ids of each text, as uint32; a null text is an empty one."""
        parts: list[bytes] = []
        last: list[bool] = []  # whether a part ends its text
        size, rest = 0, []

        def ready() -> Iterator[np.ndarray]:
            for ids, end in zip(self._ids(parts), last):
                rest.append(ids)
                if end:
                    yield rest[0] if len(rest) == 1 else np.concatenate(rest)
                    rest.clear()

        for text in texts:
            if text and self._whole(text):
                if parts:
                    yield from ready()
                    parts, last, size = [], [], 0
                yield np.array(self._encoded([text])[0], np.uint32)
                continue
            data, start = (text or "").encode(), 0
            while True:
                cut = SAFE_CUT.search(data, start + BLOCK_BYTES) if len(data) - start > 2 * BLOCK_BYTES else None
                end = cut.start() + 1 if cut else len(data)
                parts.append(data[start:end])
                last.append(cut is None)
                size, start = size + end - start, end
                if size >= BLOCK_BYTES:
                    yield from ready()
                    parts, last, size = [], [], 0
                if cut is None:
                    break
        if parts:
            yield from ready()


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    return Encoder(path)

"""Token ids of whole texts: every distinct piece of a worker is encoded once, texts are put together by number."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np

from kanaat.llm.batches import Texts, gather_lists, per_worker, span_hashes, spread
from kanaat.llm.pretokens import loaded, pieces

# Distinct pieces a worker keeps between batches; beyond, it starts afresh. Only speed depends on it.
MOST_KEPT = 1_500_000

# Ids of all words one after another, and how many each word has.
Encode = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


class Kept:
    """Encodings of pieces seen so far, found by the hash of their bytes in an open table that is at most half full."""

    def __init__(self) -> None:
        self.key, self.number = np.zeros(1 << 16, np.uint64), np.zeros(1 << 16, np.int32)
        self.start, self.count, self.size = np.zeros(1 << 15, np.int64), np.zeros(1 << 15, np.int64), 0
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each piece's encoding, -1 where there is none."""
        last = len(self.key) - 1
        at = (hashes & np.uint64(last)).view(np.int64)
        key = self.key.take(at)
        out = np.where(key == hashes, self.number.take(at), -1)
        todo = np.flatnonzero((key != hashes) & (key != 0))
        while len(todo):
            here, own = (at.take(todo) + 1) & last, hashes.take(todo)
            at[todo] = here
            key = self.key.take(here)
            found = key == own
            out[todo[found]] = self.number.take(here[found])
            todo = todo[~found & (key != 0)]
        return out

    def place(self, hashes: np.ndarray, numbers: np.ndarray) -> None:
        """Puts distinct new hashes into the table."""
        last = len(self.key) - 1
        at = (hashes & np.uint64(last)).view(np.int64)
        while len(at):
            free = self.key.take(at) == 0
            self.key[at[free]] = hashes[free]
            # Of several that want one place, the last has it.
            own = self.key.take(at) == hashes
            self.number[at[own]] = numbers[own]
            at, hashes, numbers = (at[~own] + 1) & last, hashes[~own], numbers[~own]

    def add(self, hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        size = self.size + len(hashes)
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while size > len(self.start):
            self.start, self.count = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.count))
        self.ids[self.used:self.used + len(ids)] = ids
        self.start[self.size:size], self.count[self.size:size] = self.used + np.cumsum(counts) - counts, counts
        if 2 * size > len(self.key):
            held = np.flatnonzero(self.key)
            keys, numbers, room = self.key[held], self.number[held], len(self.key)
            while 2 * size > room:
                room *= 2
            self.key, self.number = np.zeros(room, np.uint64), np.zeros(room, np.int32)
            self.place(keys, numbers)
        self.place(hashes, np.arange(self.size, size, dtype=np.int32))
        self.size, self.used = size, self.used + len(ids)

    def of_pieces(self, hashes: np.ndarray, start: np.ndarray, end: np.ndarray, raw: bytes, encode: Encode) -> np.ndarray:
        """The numbers of the pieces ``raw[start:end]``; ``encode`` gives the ids of those not seen before."""
        # 0 stands for a free place.
        hashes = np.maximum(hashes, np.uint64(1))
        number = self.numbers(hashes)
        unknown = np.flatnonzero(number < 0)
        if len(unknown):
            new, first = np.unique(hashes[unknown], return_index=True)
            first = unknown[first]
            self.add(new, *encode([raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist(), strict=True)]))
            number[unknown] = self.numbers(hashes[unknown])
        return number


def byte_letters() -> dict[int, str]:
    """The letter by which a byte-level vocabulary writes each byte: itself if it can be seen, else one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*seen}))}


def library_encode(path: str) -> Encode:
    """Words are pieces already, so the library's model gets each as it is, spelled in byte letters; its pipeline for
    whole texts would cut every word once more and keep its places, at twice the time."""
    def encode(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        tokenize, letters = loaded(path).model.tokenize, byte_letters()
        done = [[t.id for t in tokenize(w.decode("utf-8", "replace").encode().decode("latin-1").translate(letters))] for w in words]
        counts = np.fromiter(map(len, done), np.int64, len(done))
        return np.fromiter(chain.from_iterable(done), np.uint32, int(counts.sum())), counts

    return encode


def encoded(texts: Texts, path: str, encode: Encode | None = None, name: str = "library") -> tuple[np.ndarray, np.ndarray]:
    """The ids of all rows one after another, and how many each row has. ``encode`` gives the ids of distinct pieces;
    texts that spell an added token of the tokenizer are cut around it."""
    tokenizer = loaded(path)
    added = {t.content.encode(): i for i, t in tokenizer.get_added_tokens_decoder().items()}
    raw = texts.data.tobytes()
    if any(a in raw for a in added):
        return around_added(texts, path, encode, name, added)
    held = per_worker(f"kept {name} {path}", dict)
    if "all" not in held or held["all"].size > MOST_KEPT:
        held["all"] = Kept()
    kept = held["all"]
    start, end, row = pieces(texts, path)
    if not len(start):
        return np.zeros(0, np.uint32), np.zeros(texts.rows, np.int64)
    number = kept.of_pieces(span_hashes(texts.data, start, end), start, end, raw, encode or library_encode(path))
    count = kept.count.take(number)
    return gather_lists(kept.ids, kept.start.take(number), count), np.bincount(row, weights=count, minlength=texts.rows).astype(np.int64)


def around_added(texts: Texts, path: str, encode: Encode | None, name: str, added: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray]:
    """Added tokens stand for themselves; the stretches between them are encoded as texts of their own."""
    import re

    pattern = re.compile(b"|".join(re.escape(a) for a in sorted(added, key=len, reverse=True)))
    raw, out, counts = texts.data.tobytes(), [], np.zeros(texts.rows, np.int64)
    for r in range(texts.rows):
        text, at = raw[texts.at[r]:texts.at[r + 1]], 0
        parts = []
        for m in [*pattern.finditer(text), None]:
            piece = text[at:m.start() if m else len(text)]
            if piece:
                alone = Texts(np.frombuffer(piece, np.uint8), np.array([0, len(piece)]), 0)
                parts.append(encoded(alone, path, encode, name)[0])
            if m:
                parts.append(np.array([added[m[0]]], np.uint32))
                at = m.end()
        out += parts
        counts[r] = sum(map(len, parts))
    return np.concatenate(out) if out else np.zeros(0, np.uint32), counts


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each row."""
    total = np.full(len(ids) + len(counts), end_id, np.uint32)
    total[spread(np.cumsum(counts + 1) - counts - 1, counts)] = ids
    return total, counts + 1

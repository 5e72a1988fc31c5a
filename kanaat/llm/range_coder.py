"""Adaptive context-mixing range coder for token ids, many blocks in step.

A frame holds blocks of up to `BLOCK` ids. Each block starts from the same fresh state, has its own bytes and checksum, and
can be decoded alone. Numpy works on the same position of all blocks of a frame at once, so the cost of an id is a
share of some vector operations.

The model of a block. Order 2 and order 1: a small table, by the last two ids and by the last one, holds the id that
came next before and how sure it is. Order 0: how often the frame has each id that neither table foretold, counted
before coding and listed in the frame's head; ids that are rare are counted by groups of neighbours, inside a group
they are alike, so places inside groups stand beside the coder's words. The mixture P(x) = a [x = order-2 id] + b [x = order-1 id] + c order0(x) drives the coder; a and b are
learned while coding, for each degree of sureness and for whether the two ids agree.

The coder is a range variant of asymmetric numerals (rANS): its state is one number a block, a decoded id takes two
products and no division. The encoder goes over a block forwards to learn what the decoder will know, then backwards.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC, VERSION = b"KCMR", 2
BLOCK, LANES = 2048, 2048
# A short frame has shorter blocks, so that enough of them are worked on together.
FEWEST_LANES, LEAST_BLOCK = 1024, 512
TABLE_BITS = 9
# Ids with an entry of their own: at most so many, and none that is rarer than one in so many or that comes less often.
COMMON, RAREST, LEAST_SEEN = 4096, 1 << 15, 8
# The other ids are in so many groups at most, each as wide as the same power of two.
GROUPS_BITS = 8
# Steps between two lessons of a model, and how fast it learns.
ROUND, LEARN, MOST = 8, 5, 63360
# Spreads the id before the last.
HASH = 61
# Chances at first in 1 / 65536. By disagreement (0 where the ids agree), sureness of order 1 and of order 2, from nothing on.
FIRST = np.array([64, 16000, 32000, 48000])
FIRST_CHANCE2 = np.tile(FIRST, 8).astype(np.int32)
FIRST_CHANCE1 = np.where(np.arange(32) < 16, 64, np.repeat(np.tile(FIRST // 4 + 48, 2), 4)).astype(np.int32)
U = np.uint64
HALF, LOW16, WORD, FRESH = U(16), U(0xFFFF), U(32), U(1 << 32)
HEAD = "<4sHHIIQIIII"


class Checksum(ValueError):
    """A block's ids don't have its checksum."""


class Mixture:
    """What the blocks of some lanes have learned. Ids are given one higher; 0 is no id. All lanes make `ROUND` steps with
    what they know, then learn from them; arrays have a row for each step of a round."""

    def __init__(self, lanes: int) -> None:
        every, size = np.arange(lanes), 1 << TABLE_BITS
        # What the tables hold, 16 x id + sureness, that of order 1 four times as high; 0 is nothing yet.
        self.told1, self.told2 = np.zeros(lanes * size, np.int32), np.zeros(lanes * size, np.int32)
        # Chance of each prediction by both surenesses and disagreement: learned while coding.
        self.chance1, self.chance2 = np.tile(FIRST_CHANCE1, lanes), np.tile(FIRST_CHANCE2, lanes)
        self.base, self.base32 = every * size, every * 32
        rows = lambda kind: np.empty((ROUND, lanes), kind)
        self.slot1, self.slot2, self.context = (rows(np.int64) for _ in range(3))
        self.e1, self.e2, self.f1, self.f2 = (rows(np.int32) for _ in range(4))
        self.hit1, self.hit2 = rows(bool), rows(bool)

    def predict(self, at: int | slice, last: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Steps ``at`` of a round, from the ids before: the order-1 and the order-2 entry and their parts of 65536."""
        mask, e1, e2 = (1 << TABLE_BITS) - 1, self.e1[at], self.e2[at]
        self.told1.take(np.add(self.base, last & mask, out=self.slot1[at]), out=e1, mode="clip")
        self.told2.take(np.add(self.base, (last + before * np.int32(HASH)) & mask, out=self.slot2[at]), out=e2, mode="clip")
        # The surenesses are in separate bits; entries that differ by 16 or more have different ids.
        both = e1 ^ e2
        context = np.add(self.base32, (both & 15) | (np.minimum(both, 16) & 16), out=self.context[at])
        return e1, e2, self.chance1.take(context, out=self.f1[at], mode="clip"), self.chance2.take(context, out=self.f2[at], mode="clip")

    def learn(self, x: np.ndarray) -> None:
        """The chances move to what was right in the round, away from 0 and 1; the tables hold ``x``. Where steps of a
        round meet in one place the last counts."""
        n = len(x)
        # Every second step is enough for the chances.
        context = self.context[:n:2]
        for chance, f, hit in ((self.chance1, self.f1[:n:2], self.hit1[:n:2]), (self.chance2, self.f2[:n:2], self.hit2[:n:2])):
            chance[context] = f - (f >> LEARN) + (hit.view(np.int8).astype(np.int32) * (MOST >> LEARN) + 2)
        fresh = x << 4
        e1, e2 = self.e1[:n], self.e2[:n]
        self.told1[self.slot1[:n]] = np.where(e1 >> 4 == x, np.minimum(e1 + 4, e1 | 12), fresh | 4)
        self.told2[self.slot2[:n]] = np.where(self.hit2[:n], np.minimum(e2 + 1, e2 | 3), fresh | 1)


def widths(lengths: np.ndarray) -> list[int]:
    """How many lanes, whose ``lengths`` fall, have each position."""
    return np.searchsorted(-lengths, -np.arange(int(lengths[0]) if len(lengths) else 0), side="left").tolist()


def foretold(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For ``x`` (positions x lanes, ids one higher): whether a table foretells it, and its (or all others') part of
    65536, from where on and how wide."""
    hit, cum, freq = np.empty(x.shape, bool), np.empty(x.shape, np.uint16), np.empty(x.shape, np.uint16)
    model, start = Mixture(x.shape[1]), np.concatenate([np.zeros_like(x[:2]), x[:ROUND]])
    for t in range(0, len(x), ROUND):
        this = x[t:t + ROUND]
        n = len(this)
        earlier = x[t - 2:t + n] if t else start
        e1, e2, f1, f2 = model.predict(slice(0, n), earlier[1:n + 1], earlier[:n])
        hit2 = np.equal(this, e2 >> 4, out=model.hit2[:n])
        hit1 = np.greater(this == e1 >> 4, hit2, out=model.hit1[:n])
        both = f1 + f2
        hit[t:t + n] = hit1 | hit2
        cum[t:t + n] = np.where(hit2, 0, np.where(hit1, f2, both))
        freq[t:t + n] = np.where(hit2, f2, np.where(hit1, f1, 65536 - both))
        model.learn(this)
    return hit, cum, freq


class Order0:
    """Parts of 65536 of the listed ids, then of the groups of ``1 << bits`` ids; ``first`` is an entry's lowest id."""

    def __init__(self, first: np.ndarray, freq: np.ndarray, common: int, bits: int) -> None:
        self.first, self.freq, self.common, self.bits = first, freq, common, bits
        self.cum = np.cumsum(freq) - freq

    @classmethod
    def counted(cls, seen: np.ndarray) -> Order0:
        """From how often each id is to be coded."""
        total, bits = int(seen.sum()), max(1, (len(seen) - 1).bit_length() - GROUPS_BITS)
        common = np.argsort(-seen, kind="stable")[:COMMON]
        common = common[(seen[common] >= LEAST_SEEN) & (seen[common] * RAREST >= total)]
        others = seen.copy()
        others[common] = 0
        groups = np.add.reduceat(others, np.arange(0, len(others), 1 << bits))
        some = np.flatnonzero(groups)
        counts = np.concatenate([seen[common], groups[some]]).astype(np.int64)
        freq = 1 + counts * (65536 - len(counts)) // max(1, total)
        if len(freq):
            freq[np.argmax(freq)] += 65536 - int(freq.sum())
        return cls(np.concatenate([common, some << bits]), freq, len(common), bits)

    def kind(self) -> str:
        """How a place inside a group is written."""
        return f"<u{1 if self.bits <= 8 else 2 if self.bits <= 16 else 4}"

    def entries(self, highest: int) -> np.ndarray:
        """The entry of every id below ``highest``, counted from 1."""
        of_group = np.zeros((highest - 1 >> self.bits) + 1, np.uint16)
        of_group[self.first[self.common:] >> self.bits] = np.arange(self.common, len(self.first)) + 1
        entry = np.repeat(of_group, 1 << self.bits)[:highest]
        entry[self.first[:self.common]] = np.arange(self.common) + 1
        return entry


def encode_lanes(entry: np.ndarray, cum: np.ndarray, freq: np.ndarray, lengths: np.ndarray, order0: Order0) -> tuple[np.ndarray, np.ndarray]:
    """All lanes' words one after another and how many each has. ``entry`` is 0 where a table foretells the id."""
    lanes, room = len(lengths), len(entry) + 2
    words = np.empty(lanes * room, np.uint32)
    at = np.arange(1, lanes + 1) * room - 1
    state = np.full(lanes, FRESH)
    all_freq, all_cum = np.concatenate([[65536], order0.freq]).astype(np.uint64), np.concatenate([[0], order0.cum]).astype(np.uint64)
    for t, k in reversed(list(enumerate(widths(lengths)))):
        s, here, e = state[:k], at[:k], entry[t, :k]
        f0, f = all_freq.take(e), freq[t, :k].astype(np.uint64)
        high = s >> WORD
        out = np.flatnonzero(high >= f0 * f)
        there = here.take(out)
        words[there] = s.take(out).astype(np.uint32)
        here[out] = there - 1
        s[out] = high.take(out)
        q = s // f0
        s = (q << HALF) + (s - q * f0 + all_cum.take(e))
        q = s // f
        state[:k] = (q << HALF) + (s - q * f + cum[t, :k])
    words[at], words[at - 1] = state.astype(np.uint32), (state >> WORD).astype(np.uint32)
    ends = np.arange(1, lanes + 1) * room
    return np.concatenate([words[a:b] for a, b in zip((at - 1).tolist(), ends.tolist(), strict=True)]), ends - at + 1


def decode_lanes(words: np.ndarray, start: np.ndarray, inside: np.ndarray, start_inside: np.ndarray, longest: int, order0: Order0) -> np.ndarray:
    """Ids, one higher (positions x lanes), of the lanes whose words begin at ``start``, and the places inside
    groups at ``start_inside``; what a shorter one has beyond
    its end means nothing."""
    # Two rows before the first are no ids.
    x = np.zeros((longest + 2, len(start)), np.int32)
    model = Mixture(len(start))
    s, at = (words[start] << WORD) | words[start + 1], start + 2
    # For each of the 65536 places: its entry's width less 1 and how far inside it is; its lowest id as in the tables.
    of_place = np.repeat(np.arange(len(order0.freq)), order0.freq)
    part = ((order0.freq - 1)[of_place] << 16 | (np.arange(65536) - order0.cum[of_place])).astype(np.uint32)
    lowest = (order0.first + 1 << 4)[of_place].astype(np.int32)
    grouped = int(order0.freq[:order0.common].sum())
    next_inside = start_inside.copy()
    for t in range(longest):
        step = t % ROUND
        e1, e2, f1, f2 = model.predict(step, x[t + 1], x[t])
        v, both = (s & LOW16).astype(np.int32), f1 + f2
        hit2, hit = np.less(v, f2, out=model.hit2[step]), v < both
        np.greater(hit, hit2, out=model.hit1[step])
        v -= np.where(hit2, 0, np.where(hit, f2, both))
        s >>= HALF
        s *= np.where(hit2, f2, np.where(hit, f1, 65536 - both)).astype(np.uint64)
        s += v.astype(np.uint64)
        # Order 0, for all lanes; those with a hit stay as they are.
        place = (s & LOW16).view(np.int64)
        own = part.take(place, mode="clip").astype(np.uint64)
        s = np.where(hit, s, (s >> HALF) * ((own >> HALF) + U(1)) + (own & LOW16))
        got = np.right_shift(np.where(hit2, e2, np.where(hit, e1, lowest.take(place, mode="clip"))), 4, out=x[t + 2])
        low = np.flatnonzero(s < FRESH)
        here = at.take(low)
        s[low] = (s.take(low) << WORD) | words.take(here, mode="clip")
        at[low] = here + 1
        wide = np.flatnonzero((place >= grouped) > hit)
        if len(wide):
            here = next_inside.take(wide)
            got[wide] += inside.take(here, mode="clip")
            next_inside[wide] = here + 1
        if step == ROUND - 1:
            model.learn(x[t + 3 - ROUND:t + 3])
    return x[2:]


def encode_frame(ids: np.ndarray, extra: bytes = b"") -> bytes:
    """A frame of any number of ids (up to `LANES` blocks keep memory small); ``extra`` travels in its head."""
    ids = np.ascontiguousarray(ids, dtype=np.uint32)
    block = int(np.clip(len(ids) // FEWEST_LANES, LEAST_BLOCK, BLOCK))
    blocks = -(-len(ids) // block)
    highest = int(ids.max(initial=0)) + 1
    lengths = np.full(blocks, block, np.int64)
    if blocks:
        lengths[-1] = len(ids) - block * (blocks - 1)
    x = np.zeros((blocks, block), np.int32)
    x.reshape(-1)[:len(ids)] = ids
    x += 1
    groups = []
    seen = np.zeros(highest, np.int64)
    for a in range(0, blocks, LANES):
        own, length = np.ascontiguousarray(x[a:a + LANES].T), lengths[a:a + LANES]
        hit, cum, freq = foretold(own)
        # Only the last block of a frame is shorter.
        hit[length[-1]:, -1] = True
        seen += np.bincount(own[~hit] - 1, minlength=highest)
        groups.append((own, length, hit, cum, freq))
    order0 = Order0.counted(seen)
    entry_of, coded, inside, grouped = order0.entries(highest), [], [], []
    for own, length, hit, cum, freq in groups:
        entry = entry_of.take(own - 1)
        entry[hit] = 0
        # Places inside groups are alike and stand beside the coder's words, lane after lane.
        wide = (entry > order0.common).T
        inside.append(((own - 1).T[wide] & ((1 << order0.bits) - 1)).astype(order0.kind()))
        grouped.append(wide.sum(axis=1))
        coded.append(encode_lanes(entry, cum, freq, length, order0))
    words = np.concatenate([w for w, _ in coded]) if coded else np.zeros(0, np.uint32)
    n, m = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in ([c for _, c in coded], grouped))
    raw = memoryview(ids.astype("<u4").tobytes())
    checks = np.array([zlib.crc32(raw[4 * block * b:4 * block * (b + 1)]) for b in range(blocks)], "<u4")
    head = struct.pack(HEAD, MAGIC, VERSION, block, blocks, highest, len(ids), len(order0.first), order0.common, order0.bits, len(extra))
    body = head + extra + order0.first.astype("<u4").tobytes() + (order0.freq - 1).astype("<u2").tobytes() + n.astype("<u4").tobytes() + m.astype("<u4").tobytes() + checks.tobytes()
    return body + struct.pack("<I", zlib.crc32(body)) + words.astype("<u4").tobytes() + b"".join(i.tobytes() for i in inside)


def frame_head(frame: bytes) -> dict:
    """What the head says; raises `Checksum` if it is damaged."""
    magic, version, block, blocks, highest, n, entries, common, bits, extra = struct.unpack_from(HEAD, frame)
    if magic != MAGIC or version != VERSION:
        raise Checksum("not a frame of this format")
    at = struct.calcsize(HEAD) + extra
    head = {"block": block, "blocks": blocks, "highest": highest, "ids": n, "common": common, "bits": bits, "extra": frame[at - extra:at]}
    for name, kind, count in (("first", "<u4", entries), ("parts", "<u2", entries), ("words", "<u4", blocks), ("grouped", "<u4", blocks), ("checks", "<u4", blocks)):
        head[name] = np.frombuffer(frame, kind, count, at)
        at += head[name].nbytes
    if struct.unpack_from("<I", frame, at)[0] != zlib.crc32(frame[:at]):
        raise Checksum("the head of a frame is damaged")
    return head | {"at": at + 4}


def decode_frame(frame: bytes, only: list[int] | None = None) -> np.ndarray:
    """All ids of a frame, or those of the blocks ``only``."""
    head = frame_head(frame)
    blocks = np.arange(head["blocks"]) if only is None else np.asarray(only, np.int64)
    lengths = np.full(head["blocks"], head["block"], np.int64)
    if head["blocks"]:
        lengths[-1] = head["ids"] - head["block"] * (head["blocks"] - 1)
    n = head["words"].astype(np.int64)
    start = np.cumsum(n) - n
    words = np.frombuffer(frame, "<u4", int(n.sum()), head["at"]).astype(np.uint64)
    order = np.argsort(-lengths[blocks], kind="stable")
    took = blocks[order]
    order0 = Order0(head["first"].astype(np.int64), head["parts"].astype(np.int64) + 1, head["common"], head["bits"])
    m = head["grouped"].astype(np.int64)
    start_inside = np.cumsum(m) - m
    # One more, so that there is a place to read in a frame without groups.
    inside = np.append(np.frombuffer(frame, order0.kind(), int(m.sum()), head["at"] + 4 * int(n.sum())).astype(np.int32), np.int32(0))
    out = [None] * len(took)
    for a in range(0, len(took), LANES):
        group = took[a:a + LANES]
        # Damaged bytes may give other ids; the checksum then tells.
        lanes = np.ascontiguousarray((decode_lanes(words, start[group], inside, start_inside[group], int(lengths[group].max()), order0) - 1).T).astype("<u4")
        for lane, b in enumerate(group):
            ids = lanes[lane, :lengths[b]]
            if zlib.crc32(ids.tobytes()) != head["checks"][b]:
                raise Checksum(f"block {b} of a frame is damaged")
            out[order[a + lane]] = ids
    return np.concatenate(out) if out else np.zeros(0, np.uint32)

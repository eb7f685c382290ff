"""An adaptive context-mixing range coder for token ids.

A block codes up to BLOCK ids and can be read alone: it starts from a reset
model, lists the ids that occur in it, and carries a checksum of its ids. Three
predictions are mixed for every id: the one that followed the last two ids
(order 2), the one that followed the last (order 1), and the ids' adaptive
frequencies (order 0). How far each is trusted is learned for every state of
their confidence. An id is coded as a hit of order 2, a hit of order 1 or a
miss; of a miss, order 0 gives the second interval.

A block's ids are cut into STREAMS runs that advance together, one id of each a
step, and share the block's model: what a step teaches is known from the next
step on. The streams of a group's blocks are numpy lanes. Reading has to go step
by step. Writing knows all ids, so what each place of a context held is told by
one sort of the block's ids by context, and only the range coder itself goes
step by step.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np

#: Ids of a block at most, streams of a block at most, ids of a stream where the block is short, and blocks of a group (about).
BLOCK, STREAMS, STREAM, GROUP = 1 << 16, 64, 256, 64

# The format's mark and header (mark, ids, checksum, distinct ids, bytes of their list, streams).
MAGIC, HEADER = b"IDC4", struct.Struct("<4sIIIII")

# A context's place holds the id that followed it (16 bits, as the block's own number) and a confidence of 0 to 3.
_SURE, _MOST = 1 << 16, 3 << 16
_GUESS = _SURE - 1
# Places of the order-1 and order-2 tables (bits), bits of the trust's total, states of both confidences, least share of a miss.
_ONE, _TWO, _TRUST, _STATES, _LEAST = 12, 13, 14, 32, 64
_GAIN = 24
#: Steps at which frequencies and trust are taken over.
_REFRESH = (0, 4, 16, 64, 256, 512)
# The range coder: 48 bits, of which 16 leave when the span falls under 32. Whole numbers under 2 ** 53, so floats hold them.
_FULL, _FLOOR, _DOWN32, _UP16 = 2.0**48, 2.0**32, 2.0**-32, 2.0**16


def _places(last: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of the order-1 and the order-2 context."""
    h = last * 0x9E3D
    return h & ((1 << _ONE) - 1), (h >> 3) + before * 0x79B1 & ((1 << _TWO) - 1)


class Shares:
    """What a block has learned: trust by state, frequencies by id."""

    def __init__(self, size: int):
        self.size, self.bits = size, 8
        while 1 << self.bits < 4 * size:
            self.bits += 1
        self.count = np.ones(size, np.int64)
        self.outcomes = np.tile(np.array([1, 1, 2], np.int64), (_STATES, 1))

    def learn(self, ids: np.ndarray, states: np.ndarray, kinds: np.ndarray) -> None:
        """Ids, their states and how each was coded (0, 1, 2)."""
        self.count += _GAIN * np.bincount(ids.ravel(), minlength=self.size)
        self.outcomes += np.bincount((states * 3 + kinds).ravel(), minlength=self.outcomes.size).reshape(-1, 3)

    def trust(self) -> np.ndarray:
        """Of 2 ** _TRUST, by state: nothing, the share of order 2, of both orders, and all."""
        n, room = self.outcomes, (1 << _TRUST) - _LEAST
        total = n.sum(1)
        two = n[:, 0] * room // total + 1
        return np.stack([np.zeros_like(two), two, two + n[:, 1] * room // total + 1, np.full_like(two, 1 << _TRUST)], 1)

    def below(self) -> np.ndarray:
        """Of 2 ** bits: where the interval of each id begins, and where the last ends."""
        sums = np.zeros(self.size + 1, np.int64)
        np.cumsum(self.count, out=sums[1:])
        return sums * ((1 << self.bits) - self.size) // sums[-1] + np.arange(self.size + 1)


def _by_key(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys sorted, places of equal keys in order: the keys and their places."""
    kind = np.uint32 if int(keys.max(initial=0)) < 1 << 16 else np.uint64
    packed = keys.astype(kind) << kind(16) | np.arange(len(keys), dtype=kind)
    packed.sort()
    return packed >> kind(16), (packed & kind(0xFFFF)).astype(np.int64)


def _own_numbers(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, and all as numbers of these."""
    names, at = _by_key(ids)
    new = np.ones(len(ids), bool)
    new[1:] = names[1:] != names[:-1]
    own = np.empty(len(ids), np.int64)
    own[at] = np.cumsum(new) - 1
    return names[new].astype(np.int64), own


def _held(own: np.ndarray, context: np.ndarray, streams: int) -> np.ndarray:
    """What the place of each id's context held before its step; ids stand step by step.

    The last stream that names a place in a step writes it; all see what the steps before wrote.
    """
    names, at = _by_key(context)
    step = at // streams
    first = np.ones(len(at), bool)  # of a place's ids in one step
    np.logical_or(names[1:] != names[:-1], step[1:] != step[:-1], out=first[1:])
    spot = np.flatnonzero(first)
    names, x = names[spot], own[at[np.append(spot[1:], len(at)) - 1]]
    same = names[1:] == names[:-1]
    hit = same & (x[1:] == x[:-1])
    sure = same.astype(np.int64)
    sure[1:] += same[1:] & hit[:-1]
    sure[2:] += same[2:] & hit[1:-1] & hit[:-2]
    entry = np.zeros(len(x), np.int64)
    entry[1:] = (sure * _SURE + x[:-1]) * same
    held = np.empty(len(own), np.int64)
    held[at] = entry[np.cumsum(first) - 1]
    return held


def _intervals(own: np.ndarray, size: int, streams: int) -> tuple[np.ndarray, ...]:
    """Of ids that stand step by step: start and width of the first interval, then of a miss's second (0 wide for a hit), and its bits."""
    last, before = np.zeros_like(own), np.zeros_like(own)
    last[streams:], before[2 * streams :] = own[:-streams], own[: -2 * streams]
    one, two = _places(last, before)
    held1, held2 = _held(own, one, streams), _held(own, two, streams)
    guess2, guess1 = held2 & _GUESS, held1 & _GUESS
    states = (held2 >> 16 << 3) + (held1 >> 16 << 1) + (guess2 == guess1)
    kinds = np.where(guess2 == own, 0, 2 - (guess1 == own))
    shares, miss = Shares(size), kinds == 2
    done = [np.empty(len(own), np.int32) for _ in range(4)]
    for a, z in zip(_REFRESH, [*_REFRESH[1:], BLOCK], strict=True):
        a, z = a * streams, z * streams
        if a >= len(own):
            break
        edges, below = shares.trust().ravel(), shares.below()
        first, second = states[a:z] * 4 + kinds[a:z], own[a:z]
        start, low = edges.take(first), below.take(second)
        for to, what in zip(done, (start, edges.take(first + 1) - start, low, (below.take(second + 1) - low) * miss[a:z]), strict=True):
            to[a:z] = what
        shares.learn(second, states[a:z], kinds[a:z])
    return *done, shares.bits


def _listed(ids: np.ndarray) -> bytes:
    """Ascending ids as steps, each byte 255 adding to the next."""
    steps = np.diff(ids, prepend=0)
    many = steps // 255
    where = np.cumsum(many + 1) - 1
    b = np.full(int(where[-1]) + 1, 255, np.uint8)
    b[where] = steps % 255
    return zlib.compress(b.tobytes(), 1)


def _unlisted(packed: bytes) -> np.ndarray:
    b = np.frombuffer(zlib.decompress(packed), np.uint8).astype(np.int64)
    return np.cumsum(b)[b != 255]


def _dealt(n: int) -> np.ndarray:
    """Lengths of the streams of a block of n ids; the first ones are longer by one."""
    streams = min(STREAMS, -(-n // STREAM))
    return n // streams + (np.arange(streams) < n % streams)


def _by_step(ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The ids of a block, step by step instead of stream by stream."""
    whole, steps = int((lengths == lengths[0]).sum()), int(lengths[0])
    cut = whole * steps
    if whole == len(lengths):
        return ids.reshape(whole, steps).T.ravel()
    grid = np.empty((steps, len(lengths)), ids.dtype)
    grid[:, :whole] = ids[:cut].reshape(whole, steps).T
    grid[:-1, whole:] = ids[cut:].reshape(-1, steps - 1).T
    return grid.ravel()[: len(ids)]


def _encode_group(parts: list[np.ndarray]) -> list[bytes]:
    lengths = [_dealt(len(p)) for p in parts]
    first = np.cumsum([0, *map(len, lengths)])
    lanes, steps = int(first[-1]), int(max(x[0] for x in lengths))
    start, width, low2, wide = (np.zeros((steps, lanes), np.int32) for _ in range(4))
    bits, names = np.empty(lanes), []
    for k, (part, each) in enumerate(zip(parts, lengths, strict=True)):
        known, own = _own_numbers(_by_step(part, each))
        names.append(known)
        *found, shift = _intervals(own, len(known), len(each))
        for to, what in zip((start, width, low2, wide), found, strict=True):
            rows, rest = divmod(len(what), len(each))
            to[:rows, first[k] : first[k + 1]] = what[: len(what) - rest].reshape(rows, -1)
            to[rows : rows + 1, first[k] : first[k] + rest] = what[len(what) - rest :]
        bits[first[k] : first[k + 1]] = shift
    low, span, per_slot = np.zeros(lanes), np.full(lanes, _FULL), 0.5**bits
    held = np.zeros((lanes, 2 * steps + 16), np.int32)
    flat, at = held.ravel(), np.arange(lanes) * held.shape[1] + 1  # a carry may go to place 0
    rows = at - 1
    for t in range(steps):
        unit = np.floor(span * 0.5**_TRUST)
        low += unit * start[t]
        unit *= width[t]
        slot = np.floor(unit * per_slot)
        miss = wide[t] > 0
        low += slot * (low2[t] * miss)
        span = np.where(miss, slot * wide[t], unit)
        span[width[t] == 0] = _FULL  # a stream that has ended
        short = span < _FLOOR
        while short.any():
            high = np.floor(low * _DOWN32)
            flat[at] = high  # what doesn't leave yet is overwritten later
            at += short
            low = np.where(short, (low - high * _FLOOR) * _UP16, low)
            span = np.where(short, span * _UP16, span)
            short = span < _FLOOR
    for _ in range(3):
        high = np.floor(low * _DOWN32)
        flat[at] = high
        low = (low - high * _FLOOR) * _UP16
        at += 1
    while (over := held >> 16).any():  # carries go left
        held &= 0xFFFF
        held[:, :-1] += over[:, 1:]
    at -= rows
    place = np.arange(held.shape[1])
    words = held[(place > 0) & (place < at[:, None])].astype("<u2")
    ends, at = np.cumsum(at - 1), (at - 1).astype("<u4")
    done = []
    for k, part in enumerate(parts):
        listed = _listed(names[k])
        code = words[ends[first[k] - 1] if k else 0 : ends[first[k + 1] - 1]]
        done.append(HEADER.pack(MAGIC, len(part), zlib.crc32(part.astype("<u4")), len(names[k]), len(listed), len(lengths[k])) + at[first[k] : first[k + 1]].tobytes() + listed + code.tobytes())
    return done


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> list[bytes]:
    """Ids (below 2 ** 31) as independent blocks of nearly equal length, a group after another."""
    if not len(ids):
        return []
    parts = np.array_split(ids, -(-len(ids) // min(block, BLOCK)))
    return [b for a, z in _groups(len(parts)) for b in _encode_group(parts[a:z])]


def _groups(n: int) -> list[tuple[int, int]]:
    """Groups of about GROUP of n blocks."""
    cuts = np.linspace(0, n, max(1, (n + GROUP // 2) // GROUP) + 1).astype(int).tolist()
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _decode_group(blocks: list[bytes]) -> list[np.ndarray]:
    heads, names, codes, sizes = [], [], [], []
    for b in blocks:
        head = HEADER.unpack_from(b)
        if head[0] != MAGIC:
            raise ValueError("not a block of ids")
        cut = HEADER.size + 4 * head[5]
        heads.append(head)
        sizes.append(np.frombuffer(b, "<u4", head[5], HEADER.size).astype(np.int64))
        names.append(_unlisted(b[cut : cut + head[4]]))
        codes.append(np.frombuffer(b, "<u2", offset=cut + head[4]))
    of_block = np.repeat(np.arange(len(blocks)), [h[5] for h in heads])
    lengths = np.concatenate([_dealt(h[1]) for h in heads])
    order = np.argsort(-lengths, kind="stable")  # longer streams are the first lanes
    place = np.empty_like(order)
    place[order] = np.arange(len(order))
    all_sizes = np.concatenate(sizes)
    at = (np.cumsum(all_sizes) - all_sizes)[order]
    of_block, lengths = of_block[order], lengths[order]
    lanes, steps = len(order), int(lengths[0])
    active = np.searchsorted(-lengths, -np.arange(steps), "left")
    words = np.concatenate([*codes, np.zeros(8, np.uint16)])
    code = words[at] * 2.0**32 + words[at + 1] * 2.0**16 + words[at + 2]
    at += 3
    span = np.full(lanes, _FULL)
    shares = [Shares(len(n)) for n in names]
    columns = np.split(place, np.cumsum([h[5] for h in heads])[:-1])
    bits = np.array([s.bits for s in shares])
    slots, first = np.cumsum(1 << bits) - (1 << bits), np.cumsum([s.size + 1 for s in shares]) - [s.size + 1 for s in shares]
    slots, first, most, per_slot = slots[of_block], first[of_block], ((1 << bits) - 1.0)[of_block], (0.5**bits)[of_block]
    table2, table1 = np.zeros(len(blocks) << _TWO, np.int32), np.zeros(len(blocks) << _ONE, np.int32)
    base2, base1, base_state = of_block << _TWO, of_block << _ONE, of_block * (4 * _STATES)
    x_of, state_of, kind_of = (np.zeros((steps, lanes), kind) for kind in (np.uint16, np.uint8, np.uint8))
    last, before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
    edges = by_slot = below = None
    taken = 0
    for t in range(steps):
        if t in _REFRESH:
            if t:
                for s, c in zip(shares, columns, strict=True):
                    if lengths[c[0]] > t:
                        s.learn(x_of[taken:t, c], state_of[taken:t, c].astype(np.int64), kind_of[taken:t, c])
                taken = t
            edges = np.concatenate([s.trust().ravel() for s in shares]).astype(np.float64)
            each = [s.below() for s in shares]
            below = np.concatenate(each).astype(np.float32)
            by_slot = np.concatenate([np.repeat(np.arange(len(b) - 1, dtype=np.uint16), np.diff(b)) for b in each])
        n = int(active[t])
        c, s, a, x1 = code[:n], span[:n], at[:n], last[:n]
        at1, at2 = _places(x1, before[:n])
        at1 += base1[:n]
        at2 += base2[:n]
        held2, held1 = table2.take(at2), table1.take(at1)
        guess2, guess1 = held2 & _GUESS, held1 & _GUESS
        state = (held2 >> 16 << 3) + (held1 >> 16 << 1) + (guess2 == guess1)
        edge = base_state[:n] + (state << 2)
        unit = np.floor(s * 0.5**_TRUST)
        end2, end1 = unit * edges.take(edge + 1), unit * edges.take(edge + 2)
        hit2, miss = c < end2, c >= end1
        # as if all were misses
        rest = c - end1
        slot = np.floor((unit * 2.0**_TRUST - end1) * per_slot[:n])
        q = np.minimum(np.maximum(rest / slot, 0), most[:n]).astype(np.int64)
        q += slots[:n]
        found = by_slot.take(q)
        spot = first[:n] + found
        low = below.take(spot)
        spot += 1
        wide = (below.take(spot) - low) * slot
        begin = np.where(hit2, 0.0, end2)
        c = np.where(miss, rest - slot * low, c - begin)
        s = np.where(miss, wide, np.where(hit2, end2, end1) - begin)
        x = np.where(miss, found, np.where(hit2, guess2, guess1))
        short = s < _FLOOR
        while short.any():
            c = np.where(short, c * _UP16 + words.take(a, mode="clip"), c)
            s = np.where(short, s * _UP16, s)
            a += short
            short = s < _FLOOR
        code[:n], span[:n] = c, s
        x_of[t, :n], state_of[t, :n] = x, state
        kind_of[t, :n] = miss.view(np.uint8) + 1 - hit2.view(np.uint8)
        new = x + _SURE
        table2[at2] = np.where(guess2 == x, np.minimum(held2 + _SURE, x + _MOST), new)
        table1[at1] = np.where(guess1 == x, np.minimum(held1 + _SURE, x + _MOST), new)
        before[:n] = x1
        x1[:] = x
    done = []
    for head, name, c in zip(heads, names, columns, strict=True):
        own = x_of[:, c]
        long = lengths[c]
        done.append(name[np.concatenate([own[: long[k], k] for k in range(len(c))])])
        if zlib.crc32(done[-1].astype("<u4")) != head[2]:
            raise ValueError("a block fails its checksum")
    return done


def decoded_groups(blocks: list[bytes]) -> Iterator[np.ndarray]:
    """The ids of blocks in order, a group at a time; a block that fails its checksum raises ValueError."""
    for a, z in _groups(len(blocks)) if blocks else ():
        yield np.concatenate(_decode_group(blocks[a:z]))


def decode_blocks(blocks: list[bytes]) -> np.ndarray:
    return np.concatenate([np.empty(0, np.int64), *decoded_groups(blocks)])

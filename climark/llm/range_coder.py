"""Adaptive context-mixing range coder for token ids below 65,536.

A stream is cut into blocks of ``BLOCK`` ids.  Every block starts from the same
fresh model and carries its own checksum, so blocks can be read one without
another; the coder runs the blocks of a batch side by side (one lane each) and
steps through their positions together.

Model of a lane, adapted after every id:

* order 2 and order 1 each predict one id, the last that followed this
  context (a hash of two ids, or one), with a confidence of 0 to 3;
* order 0 is a distribution over 64 ranges of ids, uniform inside a range;
* mixing weights of the three orders, kept per pair of confidences, move
  towards the orders that predicted the id.

An id is coded as the choice "order 2 was right / order 1 was right / order 0"
under the mixed weights and, for order 0, its range and place in the range.
All arithmetic is on whole numbers, so every machine gets the same bytes.  The
coder's registers have 48 bits: quotients of such numbers, cut to whole ones, are exact
in doubles, whose division numpy runs on many lanes at once.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

BLOCK = 1024                      # ids in a block
SLOTS = 512                       # context slots of an order in a lane
HEAD = struct.Struct("<4sIII")    # magic, ids, crc32 of the ids as u32, payload bytes
MAGIC = b"IDR2"

_INIT, _INC = 4, 24               # order-0 counts: at the start, per id (no rescaling within BLOCK)
_HIGH, _LOW, _RATE = 61000, 400, 4
_TOP, _FULL = 1 << 32, 1 << 48    # a register's least range after a word went out, its size
_LOW32 = _TOP - 1


#: Log2 sizes of the 64 ranges: narrow where ids are frequent.
_BITS = np.repeat([4, 6, 8, 10, 12], [16, 12, 12, 12, 12]).astype(np.int64)
_BINS = len(_BITS)
_FIRST = np.concatenate([[0], np.cumsum(1 << _BITS)])[:-1]
_BIN = np.repeat(np.arange(_BINS), 1 << _BITS).astype(np.int64)
_RANGE = _BIN.astype(np.uint8)
_ROWS = np.arange(_BINS, dtype=np.uint8)[:, None]


def _targets() -> np.ndarray:
    """Where the weights of orders 2 and 1 move, by confidences, choice and
    whether both predicted the same id; a weight without a prediction stays 0."""
    out = np.zeros((4, 4, 3, 2, 2), np.int64)
    for c2, c1, choice, same in np.ndindex(4, 4, 3, 2):
        first, second = [(_LOW, _LOW), (_LOW, _HIGH), (_HIGH >> 1, _HIGH >> 1) if same else (_HIGH, _LOW)][choice]
        out[c2, c1, choice, same] = first * (c2 > 0), second * (c1 > 0)
    return out.reshape(-1, 2)


_SURER = np.array([1, 1, 1, 1, 1, 2, 3, 3])     # next confidence, by confidence and whether it was right
_TO2, _TO1 = map(np.ascontiguousarray, _targets().T)


class _Model:
    """Lane states; ``predict`` and ``update`` are the same for both directions.

    Tables hold all lanes of a slot side by side: frequent contexts are the same in
    many lanes, so their slots stay in the processor's cache."""

    def __init__(self, lanes: int):
        at = np.arange(lanes, dtype=np.int64)
        self.t1, self.t2 = np.zeros(lanes * SLOTS, np.int32), np.zeros(lanes * SLOTS, np.int32)
        fresh = np.zeros((4, 4, 2), np.int64)           # by confidence of order 2, of order 1
        fresh[1:, :, 0], fresh[:, 1:, 1] = [[9000], [20000], [30000]], [4000, 9000, 16000]
        self.weights = np.repeat(((fresh[..., 0] << 16) | fresh[..., 1]).ravel(), lanes)
        # order 0: begins and ends of the ranges, a row each with all lanes side by side
        self.bounds = np.repeat((np.arange(_BINS + 1) * _INIT).astype(np.uint16)[:, None], lanes, axis=1)
        self.bound, self.lanes, self.lane = self.bounds.reshape(-1), lanes, at
        self.ends, self.total = self.bounds[1:], _BINS * _INIT
        self.x1, self.x2 = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)

    def cut(self, lanes: int) -> None:
        """Go on with the first ``lanes`` lanes."""
        for k in ("lane", "x1", "x2"):
            setattr(self, k, getattr(self, k)[:lanes])
        self.ends = self.ends[:, :lanes]

    def predict(self):
        h1 = self.x1 * 40503
        self.i1 = ((h1 >> 4) & (SLOTS - 1)) * self.lanes + self.lane
        self.i2 = (((h1 ^ (self.x2 * 30011)) >> 5) & (SLOTS - 1)) * self.lanes + self.lane
        e1, e2 = self.t1.take(self.i1).astype(np.int64), self.t2.take(self.i2).astype(np.int64)
        self.c1, self.c2 = e1 & 3, e2 & 3
        self.p1, self.p2 = e1 >> 2, e2 >> 2
        self.pair = (self.c2 << 2) | self.c1
        self.iw = self.pair * self.lanes + self.lane
        packed = self.weights.take(self.iw)
        self.l2, self.l1 = packed >> 16, packed & 0xFFFF
        self.same = (self.p1 == self.p2) & (self.c1 > 0) & (self.c2 > 0)
        end1 = self.l2 + self.l1
        return np.where(self.same, end1, self.l2), end1    # ends of "order 2" and of "order 1" in 0..65536

    def range_of(self, b: np.ndarray):
        """(start, size) of range ``b`` of each lane in the order-0 counts."""
        at = b * self.lanes + self.lane
        begin = self.bound.take(at).astype(np.int64)
        return begin, self.bound.take(at + self.lanes) - begin

    def update(self, ids: np.ndarray, b: np.ndarray, choice: np.ndarray) -> None:
        """``b`` has the ranges of ``ids`` as bytes."""
        to = self.pair * 6 + (choice << 1) + self.same
        l2 = self.l2 + ((_TO2.take(to) - self.l2) >> _RATE)
        l1 = self.l1 + ((_TO1.take(to) - self.l1) >> _RATE)
        self.weights[self.iw] = (l2 << 16) | l1
        coded = ids << 2
        for t, i, p, c in ((self.t1, self.i1, self.p1, self.c1), (self.t2, self.i2, self.p2, self.c2)):
            t[i] = coded | _SURER.take(np.where(p == ids, c + 4, c))
        more = (_ROWS >= b).view(np.uint8)
        more *= np.uint8(_INC)
        np.add(self.ends, more, out=self.ends)
        self.total += _INC
        self.x2, self.x1 = self.x1, ids


class _Writer:
    """Range coder of many lanes: 48-bit low with carry, 16-bit output words."""

    def __init__(self, lanes: int, words: int):
        self.low, self.range = np.zeros(lanes, np.int64), np.full(lanes, _FULL - 1, np.int64)
        self.out, self.pos = np.zeros((words, lanes), np.uint16), np.arange(lanes, dtype=np.int64)
        self.flat, self.lanes = self.out.reshape(-1), lanes

    def put(self, live: int, offset: np.ndarray, rng: np.ndarray) -> None:
        """Move the first ``live`` lanes up by ``offset`` and narrow them to ``rng``."""
        pos = self.pos[:live]
        low = self.low[:live] + offset
        over = np.flatnonzero(low >= _FULL)
        if len(over):
            low[over] -= _FULL
            at = pos[over] - self.lanes
            while len(at):                               # carry into the words written before
                self.flat[at] += 1
                at = at[self.flat[at] == 0] - self.lanes
        short = rng < _TOP
        self.flat[pos] = low >> 32
        self.low[:live] = np.where(short, (low & _LOW32) << 16, low)
        self.range[:live] = np.where(short, rng << 16, rng)
        pos += short * self.lanes
        again = np.flatnonzero(self.range[:live] < _TOP)
        while len(again):                                # rare ids take a second word
            self.flat[pos[again]] = self.low[again] >> 32
            self.low[again] = (self.low[again] & _LOW32) << 16
            self.range[again] <<= 16
            pos[again] += self.lanes
            again = again[self.range[again] < _TOP]

    def end(self) -> list[bytes]:
        for _ in range(3):
            self.flat[self.pos] = self.low >> 32
            self.low, self.pos = (self.low & _LOW32) << 16, self.pos + self.lanes
        used = self.pos // self.lanes
        rows = np.ascontiguousarray(self.out[:used.max()].T.astype("<u2"))
        return [row[:n].tobytes() for row, n in zip(rows, used.tolist())]


def _over(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a // b`` of whole numbers below 2**52, towards 0."""
    return (a.astype(np.float64) / b.astype(np.float64)).astype(np.int64)


def _lengths(n: int) -> list[int]:
    return [BLOCK] * (n // BLOCK) + ([n % BLOCK] if n % BLOCK else [])


def encode_blocks(ids: np.ndarray) -> list[bytes]:
    """Blocks of a stream of ids (0 to 65,535); none for an empty stream."""
    ids = np.asarray(ids)
    if len(ids) and (ids.min() < 0 or ids.max() > 0xFFFF):
        raise ValueError("ids must lie in 0..65535")
    sizes = _lengths(len(ids))
    if not sizes:
        return []
    lanes = len(sizes)
    raw = memoryview(ids.astype("<u4").tobytes())
    grid = np.zeros(lanes * BLOCK, np.uint16)
    grid[:len(ids)] = ids
    grid = np.ascontiguousarray(grid.reshape(lanes, BLOCK).T)
    model, coder = _Model(lanes), _Writer(lanes, 3 * sizes[0] + 8)
    live = lanes
    for t in range(sizes[0]):
        if t == sizes[-1]:
            live = lanes - 1
            model.cut(live)
        if not live:
            break
        x = grid[t, :live].astype(np.int64)
        end2, end1 = model.predict()
        hit2, hit1 = (x == model.p2) & (model.c2 > 0), (x == model.p1) & (model.c1 > 0)
        hit1 |= hit2
        step = coder.range[:live] >> 16
        s2, s1 = step * end2, step * end1
        b = _BIN.take(x)
        begin, count = model.range_of(b)
        unit = ((step << 16) - s1) // model.total
        inner = (unit * count) >> _BITS.take(b)
        place = s1 + unit * begin + inner * (x - _FIRST.take(b))
        coder.put(live, np.where(hit2, 0, np.where(hit1, s2, place)),
                  np.where(hit2, s2, np.where(hit1, s1 - s2, inner)))
        model.update(x, b.astype(np.uint8), hit1.astype(np.int64) + hit2)
    out = []
    for k, payload in enumerate(coder.end()):
        own = raw[4 * k * BLOCK:4 * (k * BLOCK + sizes[k])]
        out.append(HEAD.pack(MAGIC, sizes[k], zlib.crc32(own), len(payload)) + payload)
    return out


def decode_blocks(blocks: list[bytes]) -> np.ndarray:
    """The ids of blocks, one block after the other (unsigned 32-bit).  Blocks
    may be any in any order; a damaged one raises ValueError."""
    heads = []
    for b in blocks:
        if len(b) < HEAD.size:
            raise ValueError("block too short")
        magic, n, crc, size = HEAD.unpack_from(b)
        if magic != MAGIC or len(b) != HEAD.size + size or not 0 < n <= BLOCK or size % 2:
            raise ValueError("not an id block")
        heads.append((n, crc))
    if not heads:
        return np.zeros(0, np.uint32)
    order = sorted(range(len(heads)), key=lambda k: -heads[k][0])   # longest first: lanes end from the back
    sizes = np.array([heads[k][0] for k in order])
    lanes = len(order)
    words = [np.frombuffer(blocks[k], "<u2", offset=HEAD.size) for k in order]
    rows = np.zeros((lanes, max(3, *map(len, words)) + 1), np.uint16)
    for row, w in zip(rows, words):
        row[:len(w)] = w
    flat = np.ascontiguousarray(rows.T).reshape(-1)       # as the tables: all lanes of a place
    pos = np.arange(lanes) + 3 * lanes
    code, rng = np.zeros(lanes, np.int64), np.full(lanes, _FULL - 1, np.int64)
    for k in range(3):
        code = (code << 16) | rows[:, k]
    model = _Model(lanes)
    grid = np.zeros((int(sizes[0]), lanes), np.uint16)

    for t in range(int(sizes[0])):
        live = int(np.searchsorted(-sizes, -t, side="left"))
        if live < len(code):
            code, rng, pos = code[:live], rng[:live], pos[:live]
            model.cut(live)
        end2, end1 = model.predict()
        step = rng >> 16
        s2, s1 = step * end2, step * end1
        in2, in1 = code < s2, code < s1
        unit = ((step << 16) - s1) // model.total
        rest = code - s1                                 # of lanes whose choice is order 0
        value = np.maximum(np.minimum(_over(rest, unit), model.total - 1), 0).astype(np.uint16)
        b8 = np.add.reduce((model.ends <= value).view(np.uint8), axis=0, dtype=np.uint8)
        b = b8.astype(np.int64)
        first, count = model.range_of(b)
        bits = _BITS.take(b)
        inner = (unit * count) >> bits
        rest -= unit * first
        place = np.maximum(np.minimum(_over(rest, inner), (1 << bits) - 1), 0)
        x = np.where(in2, model.p2, np.where(in1, model.p1, _FIRST.take(b) + place))
        code = np.where(in2, code, np.where(in1, code - s2, rest - inner * place))
        rng = np.where(in2, s2, np.where(in1, s1 - s2, inner))
        short = rng < _TOP
        code = np.where(short, (code << 16) | flat.take(pos, mode="clip"), code)
        rng = np.where(short, rng << 16, rng)
        pos += short * lanes
        again = np.flatnonzero(rng < _TOP)
        while len(again):
            code[again] = (code[again] << 16) | flat.take(pos[again], mode="clip")
            rng[again] <<= 16
            pos[again] += lanes
            again = again[rng[again] < _TOP]
        model.update(x, _RANGE.take(x), in1.astype(np.int64) + in2)
        grid[t, :live] = x
    out: list = [None] * lanes
    found = np.ascontiguousarray(grid.T).astype("<u4")
    for lane, k in enumerate(order):
        n, crc = heads[k]
        ids = found[lane, :n]
        if zlib.crc32(ids) != crc:
            raise ValueError("id block fails its checksum")
        out[k] = ids
    return np.concatenate(out)

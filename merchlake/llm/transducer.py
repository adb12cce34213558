"""A piece vocabulary compiled to a weighted transducer, and shortest paths of many inputs at once.

The transducer is the composition of three parts. The normaliser rewrites spaces to the space sign
and puts one in front. The piece part is a trie: an arc path that spells a piece emits its id. The
fallback part lets a character that no piece spells pass as its UTF-8 bytes. An input composed with
it is a lattice over its character positions; the tokens are its tropical shortest path.

Weights. Unigram vocabularies: minus the piece's score. Merge (BPE) vocabularies: a path is made of
pairs of neighbouring pieces, and a pair weighs 0 if merging the joined text by score gives exactly
this pair, else infinity. Merges inside pieces do not depend on their neighbours until one crosses a
border, so exactly one path has a finite weight, the one that merging would give.

Inputs are processed in step: arrays hold one entry per input, and step i finds the shortest path to
position i of all inputs.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

SPACE = "▁"
_UNIGRAM, _MERGES = 1, 2
_NORMAL, _UNKNOWN, _USER, _BYTE = 1, 2, 4, 6
_NEVER = np.int64(1) << 40


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The numbered fields of one message in the model file's wire format."""
    i = 0

    def number() -> int:
        nonlocal i
        value = shift = 0
        while True:
            byte = data[i]
            i += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while i < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}[kind] if kind != 2 else number()
        yield key >> 3, data[i : i + size]
        i += size


class Lookup:
    """A fixed map of non-negative 64-bit keys to numbers, read for whole arrays."""

    def __init__(self, entries: dict[int, int]):
        size = 1 << max(4, (3 * len(entries)).bit_length())
        self.mask = np.uint64(size - 1)
        self.keys = np.full(size, -1, np.int64)
        self.values = np.full(size, -1, np.int64)
        for key, slot in zip(entries, self._slots(np.array(list(entries), np.int64)).tolist(), strict=True):
            while self.keys[slot] != -1:
                slot = (slot + 1) & (size - 1)
            self.keys[slot] = key
            self.values[slot] = entries[key]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((h ^ (h >> np.uint64(32))) & self.mask).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values, -1 where a key is missing."""
        slots = self._slots(keys)
        there = self.keys[slots]
        out = np.where(there == keys, self.values[slots], -1)
        open_ = np.flatnonzero((there != keys) & (there != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & np.int64(self.mask)
            there = self.keys[slots[open_]]
            same = there == keys[open_]
            out[open_[same]] = self.values[slots[open_[same]]]
            open_ = open_[~same & (there != -1)]
        return out


@dataclass
class Transducer:
    """Compiled arrays; a few megabytes whatever the corpus."""

    pieces: list[str]
    merges_only: bool
    byte_ids: np.ndarray
    unknown: int
    dummy_prefix: bool
    collapse: bool
    symbols: np.ndarray
    arcs: Lookup
    ends: np.ndarray
    weights: np.ndarray
    longest: int
    ranks: np.ndarray
    left: np.ndarray
    right: np.ndarray
    joins: Lookup | None
    spaces_inside: bool

    @classmethod
    def load(cls, path: str) -> Transducer:
        """Compiles a model file. Rules that rewrite characters other than spaces are refused."""
        with open(path, "rb") as file:
            data = file.read()
        pieces, scores, kinds = [], [], []
        kind, settings = _UNIGRAM, {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                pieces.append(piece[1].decode())
                scores.append(struct.unpack("<f", piece[2])[0])
                kinds.append(piece.get(3, _NORMAL))
            elif number == 2:
                kind = dict(_fields(value)).get(3, _UNIGRAM)
            elif number == 3:
                settings = dict(_fields(value))
        if settings.get(2) or kind not in (_UNIGRAM, _MERGES):
            raise ValueError("This vocabulary has rewriting rules or a model kind that is not compiled here")
        return cls._compiled(pieces, np.array(scores), kinds, kind == _MERGES, settings)

    @classmethod
    def _compiled(cls, pieces, scores, kinds, merges: bool, settings) -> Transducer:
        spelled = {p: i for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)) if k in (_NORMAL, _USER) and p}
        # Equal scores share a rank: among them the leftmost merge comes first.
        ranks = np.unique(-scores, return_inverse=True)[1].astype(np.int64)
        left, right = np.full(len(pieces), -1, np.int64), np.full(len(pieces), -1, np.int64)
        joins: dict[int, int] = {}
        if merges:
            for piece, i in spelled.items():
                for cut in range(1, len(piece)):
                    a, b = spelled.get(piece[:cut]), spelled.get(piece[cut:])
                    if a is not None and b is not None:
                        joins[a * len(pieces) + b] = i
            for piece, i in spelled.items():
                if len(piece) > 1:
                    last = _last_merge(piece, spelled, ranks)
                    if last:
                        left[i], right[i] = last
            reachable = {p: i for p, i in spelled.items() if len(p) == 1 or left[i] >= 0}
        else:
            reachable = spelled
        characters = sorted({c for p in reachable for c in p})
        symbols = np.full(0x110000, -1, np.int32)
        symbols[[ord(c) for c in characters]] = np.arange(len(characters))
        arcs: dict[int, int] = {}
        ends = [-1]
        for piece, i in reachable.items():
            state = 0
            for c in piece:
                key = state * len(characters) + int(symbols[ord(c)])
                state = arcs.setdefault(key, len(ends))
                if state == len(ends):
                    ends.append(-1)
            ends[state] = i
        byte_ids = np.full(256, -1, np.int64)
        for i, (p, k) in enumerate(zip(pieces, kinds, strict=True)):
            if k == _BYTE:
                byte_ids[int(p[3:5], 16)] = i
        return cls(
            pieces=pieces,
            merges_only=merges,
            byte_ids=byte_ids,
            unknown=kinds.index(_UNKNOWN),
            dummy_prefix=bool(settings.get(3, 1)),
            collapse=bool(settings.get(4, 1)),
            symbols=symbols,
            arcs=Lookup(arcs),
            ends=np.array(ends, np.int64),
            weights=-scores,
            longest=max(map(len, reachable), default=1),
            ranks=ranks,
            left=left,
            right=right,
            joins=Lookup(joins) if merges else None,
            spaces_inside=any(a != SPACE and b == SPACE for p in reachable for a, b in zip(p, p[1:], strict=False)),
        )

    @property
    def _alphabet(self) -> int:
        return int(self.symbols.max()) + 1

    def shortest(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all normalised inputs one after the other, and the number of ids of each."""
        count = len(texts)
        order = np.argsort([-len(x) for x in texts], kind="stable")
        codes = np.frombuffer("".join(texts[i] for i in order).encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
        lengths = np.array([len(texts[i]) for i in order], np.int64)
        lattice = self._lattice(codes, lengths)
        # One more position per input than characters: position 0 is its begin.
        base = np.cumsum(lengths + 1) - (lengths + 1)
        first = np.cumsum(lengths) - lengths
        total = int((lengths + 1).sum())
        cost = np.full(total, np.inf)
        cost[base] = 0.0
        last = np.full(total, -1, np.int64)
        size = np.zeros(total, np.int64)
        for i in range(1, int(lengths[0]) + 1 if count else 0):
            active = int(np.searchsorted(-lengths, -i, side="right"))
            for length in range(1, min(i, self.longest) + 1):
                arc = lattice[length - 1][first[:active] + i - length]
                some = np.flatnonzero(arc != -1)
                if not len(some):
                    continue
                arc, at = arc[some], base[some] + i
                before = at - length
                weight = cost[before] + self._weight(last[before], arc, cost[before])
                better = weight < cost[at]
                at = at[better]
                cost[at], last[at], size[at] = weight[better], arc[better], length
        return self._spelled(order, base, lengths, last, size)

    def _lattice(self, codes: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
        """For each piece length, the arc that starts at each character: its id, or -1. Characters
        that no piece spells alone have the arc -2 - code."""
        n = len(codes)
        symbol = self.symbols[codes].astype(np.int64)
        room = np.repeat(np.cumsum(lengths), lengths) - np.arange(n)
        state, alive = np.zeros(n, np.int64), np.arange(n)
        arcs = []
        for length in range(1, self.longest + 1):
            alive = alive[room[alive] >= length]
            s = symbol[alive + length - 1]
            alive, s = alive[s >= 0], s[s >= 0]
            step = self.arcs.get(state[alive] * self._alphabet + s)
            alive = alive[step >= 0]
            state[alive] = step[step >= 0]
            arc = np.full(n, -1, np.int64)
            arc[alive] = self.ends[state[alive]]
            if length == 1:
                arc = np.where(arc < 0, -2 - codes, arc)
            arcs.append(arc)
        return arcs

    def _weight(self, before: np.ndarray, arc: np.ndarray, cost: np.ndarray) -> np.ndarray:
        if not self.merges_only:
            return np.where(arc >= 0, self.weights[np.maximum(arc, 0)], self.weights.max() + 10.0)
        weight = np.zeros(len(arc))
        ask = np.flatnonzero((before >= 0) & (arc >= 0) & np.isfinite(cost))
        weight[ask[~self._stable(before[ask], arc[ask])]] = np.inf
        return weight

    def _stable(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging the text of a and b gives the pair back.

        The merges are undone from the last one on, so x and y, the pieces at the border, get shorter.
        If x and y could merge before the merge undone last, merging would have crossed the border.
        Among equal ranks the merge further left comes first.
        """
        good = np.ones(len(a), bool)
        x, y, who = a.copy(), b.copy(), np.arange(len(a))
        limit, from_right = np.full(len(a), _NEVER), np.zeros(len(a), bool)
        while len(who):
            joined = self.joins.get(x * len(self.pieces) + y)
            rank = np.where(joined >= 0, self.ranks[joined], _NEVER + 1)
            crossed = (rank < limit) | (from_right & (rank == limit))
            good[who[crossed]] = False
            rank_x = np.where(self.left[x] >= 0, self.ranks[x], -1)
            rank_y = np.where(self.left[y] >= 0, self.ranks[y], -1)
            go = ~crossed & ((rank_x >= 0) | (rank_y >= 0))
            x, y, who, rank_x, rank_y = x[go], y[go], who[go], rank_x[go], rank_y[go]
            from_right = rank_y >= rank_x
            limit = np.where(from_right, rank_y, rank_x)
            x, y = np.where(from_right, x, self.right[x]), np.where(from_right, self.left[y], y)
        return good

    def _spelled(self, order, base, lengths, last, size) -> tuple[np.ndarray, np.ndarray]:
        """Follows the paths backwards and puts characters without piece down as bytes."""
        owner, back, found = [], [], []
        at, who = base + lengths, np.arange(len(order))
        step = 0
        while True:
            go = at > base[who]
            at, who = at[go], who[go]
            if not len(who):
                break
            found.append(last[at])
            owner.append(order[who])
            back.append(np.full(len(who), step))
            at = at - size[at]
            step += 1
        if not found:
            return np.zeros(0, np.int32), np.zeros(len(order), np.int64)
        ids, owner, back = np.concatenate(found), np.concatenate(owner), np.concatenate(back)
        sorted_ = np.lexsort((-back, owner))
        ids, owner = ids[sorted_], owner[sorted_]
        odd = np.flatnonzero(ids < 0)
        if len(odd):
            spelled = [self._bytes(-2 - int(ids[k])) for k in odd]
            number = np.ones(len(ids), np.int64)
            number[odd] = [len(x) for x in spelled]
            where = np.cumsum(number) - number
            out = np.repeat(ids, number)
            for k, x in zip(odd, spelled, strict=True):
                out[where[k] : where[k] + len(x)] = x
            ids, owner = out, np.repeat(owner, number)
        return ids.astype(np.int32), np.bincount(owner, minlength=len(order))

    def _bytes(self, code: int) -> list[int]:
        raw = chr(code).encode("utf-8", "replace")
        ids = [int(self.byte_ids[x]) for x in raw]
        return ids if min(ids) >= 0 else [self.unknown]


def _last_merge(piece: str, spelled: dict[str, int], ranks: np.ndarray) -> tuple[int, int] | None:
    """The two pieces whose merge completes the piece; None if merging does not give it."""
    parts = list(piece)
    while len(parts) > 2:
        best = None
        for k in range(len(parts) - 1):
            i = spelled.get(parts[k] + parts[k + 1])
            if i is not None and (best is None or ranks[i] < best[0]):
                best = (ranks[i], k)
        if best is None:
            return None
        k = best[1]
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    pair = [spelled.get(x) for x in parts]
    return (pair[0], pair[1]) if len(pair) == 2 and None not in pair else None

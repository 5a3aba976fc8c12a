"""A byte-pair vocabulary compiled into arrays, and the token counts of many words at once.

The last token of a prefix is the one piece that ends it, fits behind the last token of the shorter prefix it
leaves, and so on (two tokens fit if they are the encoding of their text). Everything this takes is bounded by the vocabulary and
compiled once: a trie of the pieces as a hash table of edges, for every piece the last merge that makes it, and the pairs of
pieces that merge. Words then go through these arrays side by side, a character at a time.

Whether two tokens fit is found by undoing the merges that made them, latest first, along the seam between
them: they don't if some pair across the seam would have been merged before.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_EMPTY = -1
_MIX = np.uint64(0x9E3779B97F4A7C15)
NONE = -1


@dataclass
class Table:
    """A hash table from non-negative whole numbers to numbers, in two arrays."""
    keys: np.ndarray
    values: np.ndarray

    @classmethod
    def of(cls, items: dict[int, int]) -> "Table":
        bits = max(4, (2 * len(items)).bit_length())
        table = cls(np.full(1 << bits, _EMPTY, np.int64), np.full(1 << bits, NONE, np.int32))
        keys, values = np.array(list(items), np.int64), np.array(list(items.values()), np.int32)
        at = table._slots(keys)
        while len(keys):
            free = table.keys[at] == _EMPTY
            table.keys[at[free]] = keys[free]  # of several keys for one slot the last stays
            here = table.keys[at] == keys
            table.values[at[here]] = values[here]
            keys, values, at = keys[~here], values[~here], (at[~here] + 1) & (len(table.keys) - 1)
        return table

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        bits = len(self.keys).bit_length() - 1
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values of ``keys``, NONE where there is none."""
        at = self._slots(keys)
        there = self.keys[at]
        out = np.where(there == keys, self.values[at], NONE)
        left = np.flatnonzero((there != keys) & (there != _EMPTY))
        while len(left):
            at[left] = (at[left] + 1) & (len(self.keys) - 1)
            there = self.keys[at[left]]
            hit = there == keys[left]
            out[left[hit]] = self.values[at[left[hit]]]
            left = left[~hit & (there != _EMPTY)]
        return out


def _last_merge(piece: str, scores: dict[str, float]) -> tuple[str, str] | None:
    """The two parts whose merge completes the encoding of ``piece``, None if that isn't the piece itself."""
    parts = list(piece)
    while len(parts) > 2:
        best = max(((scores[a + b], -k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores), default=None)
        if best is None:
            return None
        parts[-best[1]:2 - best[1]] = [parts[-best[1]] + parts[1 - best[1]]]
    return (parts[0], parts[1]) if "".join(parts) in scores else None


class PieceArrays:
    """See the module's text. Tokens are numbered: single characters first, then pieces in the order of their merges; ``unknown`` is
    any character outside the vocabulary."""

    def __init__(self, scores: dict[str, float], gap: str):
        merges = {p: m for p in scores if len(p) > 1 and (m := _last_merge(p, scores))}
        singles = sorted(p for p in scores if len(p) == 1)
        made = sorted(merges, key=lambda p: -scores[p])
        number = {p: k for k, p in enumerate([*singles, *made])}
        self.n, self.unknown = len(number), len(number)
        self.gap = number.get(gap, self.unknown)
        self.longest = max(map(len, number), default=1)
        own = np.arange(self.n + 1, dtype=np.int32)
        self.left, self.right = own.copy(), own.copy()  # a character is its own part
        for p, (a, b) in merges.items():
            if a in number and b in number:
                self.left[number[p]], self.right[number[p]] = number[a], number[b]
        self.pairs = Table.of({number[p[:k]] * (self.n + 1) + number[p[k:]]: number[p] for p in made
                               for k in range(1, len(p)) if p[:k] in number and p[k:] in number})
        nodes, edges, token = {"": 0}, {}, [NONE]
        for p, k in number.items():
            for j in range(1, len(p) + 1):
                if p[:j] not in nodes:
                    nodes[p[:j]] = len(nodes)
                    token.append(NONE)
                    edges[nodes[p[:j - 1]] << 21 | ord(p[j - 1])] = nodes[p[:j]]
            token[nodes[p]] = k
        self.edges, self.token = Table.of(edges), np.array(token, np.int32)

    def fits(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each two tokens: are they the encoding of their text? NONE before a token is the beginning."""
        out = np.ones(len(a), bool)
        at = np.flatnonzero((a != NONE) & (a != self.unknown) & (b != self.unknown))
        a, b = a[at].astype(np.int64), b[at].astype(np.int64)
        limit = np.full(len(at), self.n + 2, np.int64)  # a pair across the seam counts if its merge comes before this one
        while len(at):
            across = self.pairs.get(a * (self.n + 1) + b)
            wrong = (across != NONE) & (across < limit)
            out[at[wrong]] = False
            # undo the later of the two merges; one that is a character already leaves the other's turn
            la, rb = self.left[b].astype(np.int64), self.right[a].astype(np.int64)
            a_whole, b_whole = rb == a, la == b
            first = ((a > b) & ~a_whole) | b_whole
            done = wrong | (a_whole & b_whole)
            limit = np.where(first, a, b + 1)
            a, b = np.where(first, rb, a), np.where(first, b, la)
            go = np.flatnonzero(~done)
            at, a, b, limit = at[go], a[go], b[go], limit[go]
        return out

    def count(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per (not empty) word: its tokens, a character outside the vocabulary counting as its bytes, and
        whether the first token is a lone gap."""
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        codes = np.frombuffer("".join([words[k] for k in order]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        starts = np.cumsum(lengths) - lengths
        ends = np.repeat(starts + lengths, lengths)
        piece = np.full((self.longest, len(codes)), NONE, np.int32)  # [length - 1, first character]
        at, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        for k in range(self.longest):
            inside = at + k < ends[at]
            at, node = at[inside], node[inside]
            node = self.edges.get(node << 21 | codes[at + k]).astype(np.int64)
            known = node != NONE
            at, node = at[known], node[known]
            if not len(at):
                break
            piece[k, at] = self.token[node]
        size = np.ones(len(codes), np.int64)
        strange = np.flatnonzero(piece[0] == NONE)
        piece[0, strange] = self.unknown
        c = codes[strange]
        size[strange] = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
        last, n, lone = np.full(len(codes), NONE, np.int32), np.zeros(len(codes), np.int64), np.zeros(len(codes), bool)
        alive = len(words)
        for e in range(int(lengths[0]) if len(words) else 0):
            while lengths[alive - 1] <= e:
                alive -= 1
            open_ = starts[:alive] + e  # the last characters of the prefixes whose last tokens are still sought
            for k in range(min(e, self.longest - 1), -1, -1):
                if not len(open_):
                    break
                token = piece[k, open_ - k]
                some = np.flatnonzero(token != NONE)
                if not len(some):
                    continue
                end, token = open_[some], token[some]
                begins = k == e
                before = np.full(len(end), NONE, np.int32) if begins else last[end - k - 1]
                ok = self.fits(before, token)
                hit, token = end[ok], token[ok]
                last[hit] = token
                own = np.where(token == self.unknown, size[hit], 1)
                n[hit] = own if begins else own + n[hit - k - 1]
                lone[hit] = token == self.gap if begins else lone[hit - k - 1]
                keep = np.ones(len(open_), bool)
                keep[some[ok]] = False
                open_ = open_[keep]
            if len(open_):
                raise AssertionError("a prefix without a last token")
        final = starts + lengths - 1
        counts, alone = np.empty(len(words), np.int64), np.empty(len(words), bool)
        counts[order], alone[order] = n[final], lone[final]
        return counts, alone

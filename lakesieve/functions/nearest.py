"""The likest known name of each name: bounds from words and from a tree of characters, name_score where they leave a doubt.

Nothing is left out: a pair goes unscored only if a bound shows that its score is
lower than one already found (or `least`), or equal and later in the known names' order.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import defaultdict
from dataclasses import dataclass

import numpy as np

from lakesieve.functions.similarity import name_score

# Kinds of characters that are counted apart; pairs of a name and a
# node at a time; nodes of a name from which on the most promising is scored at once.
KINDS, PAIRS, MANY = 48, 1_000_000, 8
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


@dataclass
class _Level:
    """Nodes of one depth, in the order of their parents."""

    char: np.ndarray
    low: np.ndarray  # the first known name under the node
    least: np.ndarray  # lengths under the node
    most: np.ndarray
    end: np.ndarray  # the known name that ends here, or -1
    first: np.ndarray  # of each node a level up: its first child, and how many it has
    children: np.ndarray
    row: np.ndarray  # where the node's counts are; -1: as its parent's
    counts: np.ndarray  # of each kind of character, the most that a name under the node has


class _Tree:
    """Known names as a tree of characters."""

    def __init__(self, names: list[str], ids: list[int]) -> None:
        order = sorted(range(len(ids)), key=lambda i: names[ids[i]])
        self.ids = np.array([ids[i] for i in order], dtype=np.int64)
        self.names = [names[i] for i in self.ids]
        size = np.array([len(x) for x in self.names], dtype=np.int64)
        self.chars, code = np.unique(_codes("".join(self.names)), return_inverse=True)
        begin = np.cumsum(size) - size
        often = np.argsort(-np.bincount(code), kind="stable")
        self.kind = np.full(len(self.chars), KINDS - 1)
        self.kind[often[: KINDS - 1]] = np.arange(min(len(often), KINDS - 1))
        of = np.repeat(np.arange(len(size)), size)
        held = np.bincount(of * KINDS + self.kind[code], minlength=len(size) * KINDS).reshape(-1, KINDS)
        held = held.astype(np.min_scalar_type(int(size.max(initial=0))))
        self.top = held.max(axis=0, initial=0)
        self.levels: list[_Level] = []
        node, above, names_in = np.zeros(len(size), dtype=np.int64), 1, np.arange(len(size))
        for d in range(1, int(size.max(initial=0)) + 1):
            names_in = names_in[size[names_in] >= d]
            c, parent = code[begin[names_in] + d - 1], node[names_in]
            new = np.ones(len(names_in), dtype=bool)
            new[1:] = (c[1:] != c[:-1]) | (parent[1:] != parent[:-1])
            at, own = np.flatnonzero(new), np.cumsum(new) - 1
            node[names_in] = own
            children = np.bincount(parent[at], minlength=above)
            row = np.where(children[parent[at]] > 1, 0, -1)
            apart = np.flatnonzero(row == 0)
            row[apart] = np.arange(len(apart))
            ids_in, end = self.ids[names_in], np.full(len(at), -1)
            ends = size[names_in] == d
            end[own[ends]] = ids_in[ends]
            self.levels.append(_Level(c[at], np.minimum.reduceat(ids_in, at), np.minimum.reduceat(size[names_in], at), np.maximum.reduceat(size[names_in], at), end, np.cumsum(children) - children, children, row, np.maximum.reduceat(held[names_in], at, axis=0)[apart]))
            above = len(at)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")


class _Best:
    """The best of each name so far."""

    def __init__(self, asked: list[str], known: list[str], least: float, stop: tuple[str, ...]) -> None:
        self.asked, self.known, self.stop = asked, known, stop
        self.score, self.id = np.full(len(asked), float(least)), np.full(len(asked), len(known), dtype=np.int64)
        self.seen: dict[int, set[int]] = defaultdict(set)

    def open(self, i, score, j):
        """Whether a score of known names from the j-th on could be better."""
        return (score > self.score[i]) | ((score == self.score[i]) & (j < self.id[i]))

    def look(self, i: int, j: int) -> None:
        if j not in self.seen[i]:
            self.seen[i].add(j)
            score = name_score(self.asked[i], self.known[j], self.stop)
            if self.open(i, score, j):
                self.score[i], self.id[i] = score, j


def likest(asked: list[str], known: list[str], least: float, stop: tuple[str, ...] = ()) -> tuple[list[int], list[int], list[float]]:
    """Places of names and of their likest known ones, with scores of `least` (over 0) or more: of equal ones the first known.

    Both lists hold distinct names that aren't empty.
    """
    words = lambda x: set(x.split()) - set(stop)
    best, held, place = _Best(asked, known, least, stop), [words(x) for x in known], {x: j for j, x in enumerate(known)}
    asks = [words(x) for x in asked]
    own = [j for j, y in enumerate(held) if y]
    tree = _Tree(known, own)
    for i, a in enumerate(asked):
        if a in place:
            best.look(i, place[a])
        elif asks[i]:
            at = bisect_left(tree.names, a)
            for j in tree.ids[max(0, at - 1) : at + 1]:
                best.look(i, int(j))
    _by_part(best, asks, held, {known[j]: j for j in own})
    _by_words(best, asks, held)
    # a ratio of 1 is that of equal names only
    _by_tree(best, [i for i, x in enumerate(asks) if x and best.score[i] < 1], tree)
    found = [i for i in range(len(asked)) if best.id[i] < len(known)]
    return found, [int(best.id[i]) for i in found], [float(best.score[i]) for i in found]


def _parts(text: str, sizes: list[int]):
    """What the text holds in the given lengths, itself left out."""
    for n in sizes:
        if n >= len(text):
            return
        for k in range(len(text) - n + 1):
            yield text[k : k + n]


def _by_part(best: _Best, asks: list[set], held: list[set], place: dict[str, int]) -> None:
    """Names of which one holds the other: a share of words, and a quarter."""
    of = {a: i for i, a in enumerate(best.asked) if asks[i]}
    asking, known = sorted({len(a) for a in of}), sorted({len(b) for b in place})
    pairs = [(of[x], j) for b, j in place.items() for x in set(_parts(b, asking)) if x in of]
    pairs += [(i, place[x]) for a, i in of.items() for x in set(_parts(a, known)) if x in place]
    for i, j in pairs:
        x, y = asks[i], held[j]
        if best.open(i, min(1.0, len(x & y) / max(len(x), len(y)) + 0.25), j):
            best.look(i, j)


def _by_words(best: _Best, asks: list[set], held: list[set]) -> None:
    """The largest share of common words: who has k of p words has one of the p - k + 1 rarest."""
    lists = defaultdict(list)
    for j, y in enumerate(held):
        for w in y:
            lists[w].append(j)
    lists = {w: np.array(x, dtype=np.int64) for w, x in lists.items()}
    size = np.array([len(y) for y in held], dtype=np.int64)
    for i, x in enumerate(asks):
        p, mine = len(x), sorted((lists[w] for w in x if w in lists), key=len)
        need = next((k for k in range(1, p + 1) if k / p >= best.score[i]), p + 1)
        take = len(mine) - need + 1
        if take < 1:
            continue
        ids = mine[0] if take == 1 else np.unique(np.concatenate(mine[:take]))
        ids = ids[np.minimum(size[ids], p) / np.maximum(size[ids], p) >= best.score[i]]
        if len(ids):
            common = sum((of[np.minimum(np.searchsorted(of, ids), len(of) - 1)] == ids).astype(np.int64) for of in mine)
            share = common / np.maximum(size[ids], p)
            j = int(ids[np.argmax(share)])
            if best.open(i, share.max(), j):
                best.look(i, j)


def _by_tree(best: _Best, todo: list[int], tree: _Tree) -> None:
    """The largest ratio. Matching blocks make a common subsequence, so that they are bounded by the longest one.

    Its length is worked out along the tree, a bit for each character of a name; a
    node's bound adds what the rest of a name under it may have in common.
    """
    if not tree.levels:
        return
    todo = sorted(todo, key=lambda i: len(best.asked[i]))
    step = max(1, PAIRS // len(tree.ids))
    for k in range(0, len(todo), step):
        _walk(best, np.array(todo[k : k + step]), tree)


def _walk(best: _Best, todo: np.ndarray, tree: _Tree) -> None:
    texts = [best.asked[i] for i in todo]
    size = np.array([len(x) for x in texts])
    code, of = _codes("".join(texts)), np.repeat(np.arange(len(texts)), size)
    bit = np.arange(len(code)) - np.repeat(np.cumsum(size) - size, size)
    char = np.minimum(np.searchsorted(tree.chars, code), len(tree.chars) - 1)
    same = tree.chars[char] == code
    n_words = int(size.max() + 63) // 64
    masks = np.zeros((n_words, len(texts), len(tree.chars)), dtype=np.uint64)
    np.bitwise_or.at(masks, (bit[same] // 64, of[same], char[same]), np.uint64(1) << (bit[same] % 64).astype(np.uint64))
    counts = np.bincount(of[same] * KINDS + tree.kind[char[same]], minlength=len(texts) * KINDS).reshape(-1, KINDS)
    # wide enough for either side: the lesser of two counts is at most the tree's
    counts = np.minimum(counts, np.iinfo(tree.top.dtype).max).astype(tree.top.dtype)
    q, node = np.arange(len(texts)), np.zeros(len(texts), dtype=np.int64)
    v, cap = np.full((n_words, len(texts)), ALL), np.minimum(counts, tree.top).sum(axis=1, dtype=np.int64)
    ends = []
    for d, at in enumerate(tree.levels, 1):
        n = at.children[node]
        up = np.repeat(np.arange(len(q)), n)
        if not len(up):
            break
        node = at.first[node][up] + np.arange(len(up)) - (np.cumsum(n) - n)[up]
        q, v, cap = q[up], v[:, up], cap[up]
        new = np.flatnonzero(at.row[node] >= 0)
        cap[new] = np.minimum(counts[q[new]], at.counts[at.row[node[new]]]).sum(axis=1, dtype=np.int64)
        carry = np.zeros(len(q), dtype=np.uint64)
        common = np.zeros(len(q), dtype=np.int64)
        for w in range(n_words):
            u = v[w] & masks[w, q, at.char[node]]
            once = v[w] + u
            both = once + carry
            carry = ((once < u) | (both < once)).astype(np.uint64)
            v[w] = both | (v[w] & ~u)
            # bits beyond the name's length have no mask: they stay set
            common += np.bitwise_count(~v[w])
        more = np.clip(cap - common, at.least[node] - d, at.most[node] - d)
        bound = 2.0 * np.minimum(cap, common + more) / (size[q] + d + more)
        whole = np.flatnonzero(at.end[node] >= 0)
        if len(whole):
            ratio = 2.0 * common[whole] / (size[q[whole]] + d)
            good = best.open(todo[q[whole]], ratio, at.end[node[whole]])
            ends.append((q[whole[good]], ratio[good], at.end[node[whole[good]]]))
        keep = np.flatnonzero(best.open(todo[q], bound, at.low[node]) & (at.most[node] > d))
        if not len(keep):
            break
        q, node, v, cap, bound = q[keep], node[keep], v[:, keep], cap[keep], bound[keep]
        start = np.flatnonzero(np.r_[True, q[1:] != q[:-1]])
        many = np.diff(np.r_[start, len(q)])
        if many.max() > MANY:
            top = np.repeat(np.maximum.reduceat(bound, start), many)
            low = np.minimum.reduceat(np.where(bound == top, at.low[node], len(best.known)), start)
            for i, j in zip(todo[q[start[many > MANY]]], low[many > MANY], strict=True):
                best.look(int(i), int(j))
            keep = np.flatnonzero(best.open(todo[q], bound, at.low[node]))
            q, node, v, cap = q[keep], node[keep], v[:, keep], cap[keep]
    if ends:
        q, ratio, j = (np.concatenate(x) for x in zip(*ends, strict=True))
        for k in np.lexsort((j, -ratio, q)):
            if best.open(i := int(todo[q[k]]), ratio[k], j[k]):
                best.look(i, int(j[k]))

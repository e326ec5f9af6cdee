"""Runs of a text: maximal periodic stretches of its words, found with suffix trees.

A run is a stretch whose words repeat at distance q, its smallest period, at least twice over, and that no neighbouring
word extends. Every run has a Lyndon word as a root: the longest Lyndon word that starts at some place, in one of the two
orders of the symbols (as given or reversed; a prefix is smaller in both). That word ends where the next smaller suffix
starts, which the ranks of the leaves of a suffix tree tell. Each such root is extended to the right by the longest
common extension of the two places behind it and to the left by that of the reversed text; if both together give another
period, the stretch is a run. Extensions are lowest common ancestors in the trees of the text and of its reversal
(Ukkonen's construction): an Euler tour notes the depth of the shallowest node between neighbouring leaves, and a sparse
table answers the minimum over any range of them in constant time, for all roots at once.

Trees are built only where a run can be. A run of ``least`` words has each of its words in a window of ``(least + 1) // 2``
words that occurs again in the same run. So stretches that no repeated window covers are cut out, exactly, until none is
left; whatever remains is searched whole. Equal windows are recognised by hash, where a collision merely keeps more.

Defined cases: null, empty and wordless texts have no words and no runs. Repeated rows get equal results; extra columns
are kept in ``row``. Memory is in proportion to the longest stretch, about 500 bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storeloom.llm.texts import map_texts

# Fixed by the output contract: the shortest run.
LEAST = 12
ENDLESS = 1 << 62

RUN = T.StructType([T.StructField(name, T.LongType()) for name in ("start", "length", "period")])
ADDED = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)),
                      T.StructField("collapsed", T.BinaryType())])


class SuffixTree:
    """Ukkonen's suffix tree of symbols (integers from 0) and an end mark that is smaller than all."""

    def __init__(self, symbols: Sequence[int]):
        text = [*symbols, -1]
        starts, ends, links, below = [0], [0], [0], [{}]
        node = edge = matched = waiting = 0

        def add(start: int, end: int, children: dict | None) -> int:
            starts.append(start)
            ends.append(end)
            links.append(0)
            below.append(children)
            return len(starts) - 1

        for i, symbol in enumerate(text):
            waiting += 1
            fresh = 0  # an inner node of this step that still lacks its link
            while waiting:
                if not matched:
                    edge = i
                first = text[edge]
                child = below[node].get(first)
                if child is None:
                    below[node][first] = add(i, ENDLESS, None)
                    inner = node
                else:
                    start = starts[child]
                    width = min(ends[child], i + 1) - start
                    if matched >= width:
                        edge += width
                        matched -= width
                        node = child
                        continue
                    if text[start + matched] == symbol:
                        matched += 1
                        if fresh:
                            links[fresh] = node
                        break
                    inner = add(start, start + matched, {text[start + matched]: child, symbol: add(i, ENDLESS, None)})
                    below[node][first] = inner
                    starts[child] = start + matched
                if fresh:
                    links[fresh] = inner
                fresh = inner
                waiting -= 1
                if node:
                    node = links[node]
                elif matched:
                    matched -= 1
                    edge = i - waiting + 1
        self.size = len(text)
        self._starts, self._ends, self._below = starts, ends, below

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of their leaves, and the depth of the lowest common ancestor of each leaf and the one
        before it. ``reverse`` turns the order of the symbols; the end mark stays the smallest."""
        starts, ends, below, size = self._starts, self._ends, self._below, self.size
        leaves, shared = np.empty(size, np.int32), np.empty(size, np.int32)
        stack, least, found = [(0, 0)], 0, 0
        while stack:
            node, above = stack.pop()
            if above < least:
                least = above
            children = below[node]
            if children is None:
                leaves[found], shared[found] = starts[node] - above, least
                found += 1
                least = size
                continue
            depth = above + ends[node] - starts[node]
            # The stack hands out the last child first.
            if len(children) == 2:
                (a, x), (b, y) = children.items()
                ordered = [x, y] if (a > b) != reverse else [y, x]
                if reverse and -1 in children:
                    ordered.reverse()
            else:
                keys = sorted(children, reverse=not reverse)
                if reverse and keys[0] == -1:
                    keys.append(keys.pop(0))
                ordered = [children[k] for k in keys]
            stack.extend([(child, depth) for child in ordered])
        return leaves, shared


class CommonExtensions:
    """Lengths of the longest common extensions of pairs of places, each in constant time."""

    def __init__(self, leaves: np.ndarray, shared: np.ndarray):
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self._least = [shared]
        width = 1
        while 2 * width < len(shared):
            last = self._least[-1]
            self._least.append(np.minimum(last[:-width], last[width:]))
            width *= 2

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        low, high = np.minimum(self.rank[a], self.rank[b]) + 1, np.maximum(self.rank[a], self.rank[b])
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(a), np.int64)
        for k in np.unique(level).tolist():
            mine = level == k
            table = self._least[k]
            out[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << k) + 1])
        return out


def next_smaller(rank: np.ndarray) -> np.ndarray:
    """For each suffix but the end mark, where the next smaller suffix starts."""
    ranks, out, open_ = rank.tolist(), [0] * (len(rank) - 1), []
    for place, mine in enumerate(ranks):
        while open_ and ranks[open_[-1]] > mine:
            out[open_.pop()] = place
        open_.append(place)
    return np.array(out, np.int64)


def runs_of(symbols: Sequence[int], least: int = LEAST) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of all runs of at least ``least`` symbols, by start, then period."""
    n = len(symbols)
    if n < max(2, least):
        return []
    forward = SuffixTree(symbols)
    orders = [forward.tour(), forward.tour(reverse=True)]
    del forward
    right = CommonExtensions(*orders[0])
    backward = SuffixTree(symbols[::-1])
    left = CommonExtensions(*backward.tour())
    del backward
    starts, ends = [], []
    for leaves, _ in orders:
        rank = np.empty(n + 1, np.int64)
        rank[leaves] = np.arange(n + 1)
        starts.append(np.arange(n))
        ends.append(next_smaller(rank))
    start, end = np.concatenate(starts), np.concatenate(ends)
    period = end - start
    after, before = np.zeros(len(start), np.int64), np.zeros(len(start), np.int64)
    inside = end < n
    after[inside] = right(start[inside], end[inside])
    inside = start > 0
    before[inside] = left(n - start[inside], n - end[inside])
    length = before + period + after
    kept = (length >= 2 * period) & (length >= least)
    found = np.unique(np.stack([start - before, period, length], axis=1)[kept], axis=0)
    return [(s, size, p) for s, p, size in found.tolist()]


def repetitive(hashes: np.ndarray, owner: np.ndarray, least: int) -> list[tuple[int, int]]:
    """(start, end) of the stretches of a slice's words that can hold a run: each of their words is in a window that occurs
    at least twice in the stretch. ``owner`` numbers the texts."""
    window = (least + 1) // 2
    place = np.arange(len(hashes))
    while True:
        if len(place) < least:
            return []
        follows = np.diff(place) == 1
        fresh = np.concatenate([[True], ~follows | (owner[1:] != owner[:-1])])
        stretch = np.cumsum(fresh) - 1
        begin = np.flatnonzero(fresh)
        end = np.append(begin[1:], len(place))
        usable = len(place) - window + 1
        gram = np.zeros(usable, np.uint64)
        for k in range(window):
            gram = gram * np.uint64(0x9E3779B97F4A7C15) + hashes[k:k + usable]
        gram ^= stretch[:usable].astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        whole = np.flatnonzero(stretch[:usable] == stretch[window - 1:])
        if not len(whole):
            return []
        order = np.argsort(gram[whole], kind="stable")
        ranked = gram[whole][order]
        same = np.concatenate([[False], ranked[1:] == ranked[:-1], [False]])
        again = whole[order[same[1:] | same[:-1]]]
        change = np.zeros(len(place) + 1, np.int64)
        np.add.at(change, again, 1)
        np.add.at(change, again + window, -1)
        covered = np.cumsum(change[:-1]) > 0
        if covered.all():
            return [(int(place[a]), int(place[b - 1]) + 1) for a, b in zip(begin, end, strict=True) if b - a >= least]
        place, hashes, owner = place[covered], hashes[covered], owner[covered]
        # Stretches too short for a run go as well.
        fresh = np.concatenate([[True], (np.diff(place) != 1) | (owner[1:] != owner[:-1])]) if len(place) else np.zeros(0, bool)
        sizes = np.diff(np.append(np.flatnonzero(fresh), len(place)))
        long = np.repeat(sizes >= least, sizes)
        place, hashes, owner = place[long], hashes[long], owner[long]


def runs_of_texts(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several texts, given as words."""
    sizes = [len(words) for words in texts]
    first = np.concatenate([[0], np.cumsum(sizes)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not first[-1]:
        return out
    hashes = np.concatenate([np.fromiter(map(hash, words), np.int64, len(words)) for words in texts]).view(np.uint64)
    for start, end in repetitive(hashes, np.repeat(np.arange(len(texts)), sizes), least):
        text = int(np.searchsorted(first, start, side="right")) - 1
        offset = start - int(first[text])
        words = texts[text][offset:offset + end - start]
        numbers: dict[bytes, int] = {}
        out[text] += [(s + offset, size, p) for s, size, p in runs_of([numbers.setdefault(w, len(numbers)) for w in words], least)]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in out]


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that a run repeats: of each run its first period stays."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [w for w, dropped in zip(words, np.cumsum(change[:-1]).tolist(), strict=True) if not dropped]


def find(documents: DataFrame, text: Column, least: int = LEAST, keep: Sequence[str] | None = None) -> DataFrame:
    """All rows with n_words, their runs (by start, then period) and the collapsed text, words joined by one blank."""
    def run(slices: Iterator[list[bytes | None]]) -> Iterator[list[list]]:
        for texts in slices:
            words = [(t or b"").split() for t in texts]
            runs = runs_of_texts(words, least)
            yield [[len(w) for w in words],
                   [[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs],
                   [b" ".join(collapse(w, r)) for w, r in zip(words, runs, strict=True)]]

    found = map_texts(documents, text, ADDED, run, keep=keep)
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def longest(runs: Column) -> Column:
    """The run of greatest length, ties by start, then period; null without runs."""
    keyed = F.transform(runs, lambda r: F.struct((-r["length"]).alias("k"), r["start"].alias("start"), r["period"].alias("period"),
                                                 r["length"].alias("length")))
    return F.array_min(keyed)

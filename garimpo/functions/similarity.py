"""Token-sort similarity on a 0-100 scale.

The ratio of two texts is 200 * LCS / (len1 + len2), LCS being the length of
their longest common subsequence.  Spark's ``levenshtein`` allows
substitutions and gives other values, hence the Arrow UDFs; they run only on
candidate pairs that passed the JVM-side bounds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import BooleanType, DoubleType


def lcs_length(a: str, b: str) -> int:
    """Longest common subsequence, one machine operation per row of the table."""
    if a == b:
        return len(a)
    if len(a) < len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, char in enumerate(a):
        places[char] = places.get(char, 0) | (1 << i)
    full = (1 << len(a)) - 1
    open_bits = full
    for char in b:
        hit = open_bits & places.get(char, 0)
        open_bits = ((open_bits + hit) | (open_bits - hit)) & full
    return len(a) - open_bits.bit_count()


def reaches(a: str, b: str, threshold: int) -> bool:
    """Whether the ratio is at least ``threshold``, in whole numbers."""
    if a == b:
        return True
    total = len(a) + len(b)
    if 200 * min(len(a), len(b)) < threshold * total:
        return False
    return 200 * lcs_length(a, b) >= threshold * total


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 100.0 if total == 0 else 100.0 * (1.0 - (total - 2 * lcs_length(a, b)) / total)


class TextSet:
    """Texts of one task, compared in vectors.

    Pairs are bounded by their lengths and by the characters they share; for what is left one
    bit-parallel table runs over all pairs at once, in as many 64-bit words as a text needs.  Texts of
    more than ``LONGEST`` characters on both sides use one long number a pair, which is faster there.
    """

    WORD, LONGEST, CHUNK = 64, 512, 2**16
    MOST = 16  # repetitions of a character that the bound tells apart

    def __init__(self, texts: list[str]) -> None:
        self.texts = texts
        self.sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        every = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        self.letters, codes = np.unique(every, return_inverse=True)
        self.flat = codes.astype(np.int32) + 1  # 0 pads and matches nothing
        self.first = np.cumsum(self.sizes) - self.sizes
        self._bound: tuple[np.ndarray, np.ndarray] | None = None

    def pairs(self, i: np.ndarray, j: np.ndarray, threshold: int) -> np.ndarray:
        """Whether the texts ``i`` and ``j`` (indexes, one pair a place) reach the threshold."""
        total = self.sizes[i] + self.sizes[j]
        hit = i == j
        open_ = np.flatnonzero(~hit & (200 * np.minimum(self.sizes[i], self.sizes[j]) >= threshold * total))
        hit[open_] = 200 * self.common(i[open_], j[open_]) >= threshold * total[open_]
        return hit

    def grid(self, rows: np.ndarray, others: np.ndarray, threshold: int) -> np.ndarray:
        """Which of ``rows`` (indexes) reach the threshold with which of ``others``."""
        if self._bound is None:
            self._bound = self._shared_bound()
        unary, over = self._bound
        hits = np.zeros((len(rows), len(others)), dtype=bool)
        step = max(1, 2**21 // max(1, len(others)))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            sizes, lengths = self.sizes[part][:, None], self.sizes[others][None, :]
            shared = unary[part] @ unary[others].T + np.minimum(over[part][:, None], over[others][None, :])
            shared = np.minimum(shared, np.minimum(sizes, lengths))
            a, b = np.nonzero(200 * shared >= threshold * (sizes + lengths))
            hits[at + a, b] = self.pairs(part[a], others[b], threshold)
        return hits

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common subsequence of each pair of indexes."""
        out = np.zeros(len(i), dtype=np.int64)
        words = np.maximum(1, -(-self.sizes[i] // self.WORD))
        huge = (words * self.WORD > self.LONGEST) & (self.sizes[j] > self.LONGEST)
        for k in np.flatnonzero(huge):
            out[k] = lcs_length(self.texts[i[k]], self.texts[j[k]])
        swap = ~huge & (self.sizes[i] > self.sizes[j])  # the table is as wide as the shorter text
        i, j = np.where(swap, j, i), np.where(swap, i, j)
        words = np.maximum(1, -(-self.sizes[i] // self.WORD))
        order = np.lexsort((i, self.sizes[j], words))
        order = order[~huge[order]]
        cuts = np.flatnonzero(np.diff(words[order])) + 1
        for group in np.split(order, cuts):
            for at in range(0, len(group), self.CHUNK):
                part = group[at : at + self.CHUNK]
                out[part] = self._table(i[part], j[part], int(words[part[0]]))
        return out

    def _table(self, i: np.ndarray, j: np.ndarray, words: int) -> np.ndarray:
        """The bit-parallel table of pairs whose first texts fit so many words."""
        left, own = np.unique(i, return_inverse=True)
        right, other = np.unique(j, return_inverse=True)
        step = max(1, 2**22 // ((len(self.letters) + 1) * words))
        if len(left) > step:  # masks of some texts at a time
            out = np.zeros(len(i), dtype=np.int64)
            for at in range(0, len(left), step):
                some = (own >= at) & (own < at + step)
                out[some] = self._table(i[some], j[some], words)
            return out
        masks = np.zeros((len(left), len(self.letters) + 1, words), dtype=np.uint64)
        for place, column in enumerate(self._columns(left)):
            here = np.flatnonzero(column)
            masks[here, column[here], place // self.WORD] |= np.uint64(1 << place % self.WORD)
        bits = np.full((words, len(i)), 2**64 - 1, dtype=np.uint64)
        for column in self._columns(right):
            mask = masks[own, column[other]]
            carry = None
            for w in range(words):
                row = bits[w]
                hit = row & mask[:, w]
                total = row + hit
                if words > 1:
                    over = total < row
                    if carry is not None:
                        total += carry
                        over |= carry & (total == 0)
                    carry = over
                bits[w] = total | (row - hit)
        size = self.sizes[i]
        shared = np.zeros(len(i), dtype=np.int64)
        for w in range(words):
            held = np.clip(size - w * self.WORD, 0, self.WORD).astype(np.uint64)
            full = np.where(held == 64, np.uint64(2**64 - 1), (np.uint64(1) << (held % np.uint64(64))) - np.uint64(1))
            shared += np.bitwise_count(~bits[w] & full)
        return shared

    def _columns(self, which: np.ndarray):
        """The n-th characters of all those texts, for every n; 0 beyond a text's end."""
        first, sizes = self.first[which], self.sizes[which]
        padded = np.append(self.flat, 0)
        for n in range(int(sizes.max(initial=0))):
            yield padded[np.where(n < sizes, first + n, len(self.flat))]

    def _shared_bound(self) -> tuple[np.ndarray, np.ndarray]:
        """Characters in unary, so that products count the shared ones, and how many did not fit."""
        n, buckets = len(self.texts), min(len(self.letters), 128) or 1
        owner = np.repeat(np.arange(n), self.sizes)
        counts = np.bincount(owner * buckets + (self.flat - 1) % buckets, minlength=n * buckets).reshape(n, buckets)
        over = np.maximum(counts - self.MOST, 0).sum(axis=1)
        most = np.minimum(counts.max(axis=0, initial=0), self.MOST)
        letter = np.repeat(np.arange(buckets), most)
        level = np.arange(len(letter)) - np.repeat(np.cumsum(most) - most, most)
        return (counts[:, letter] > level).astype(np.float32), over.astype(np.float32)

    def reached(self, i: int, others: np.ndarray, threshold: int) -> np.ndarray:
        """Those of ``others`` (indexes) that reach the threshold with text ``i``, in their order."""
        return others[self.grid(np.array([i]), others, threshold)[0]]

    def first_reached(self, i: int, others: np.ndarray, threshold: int) -> int:
        """The first of ``others`` that reaches the threshold, or -1."""
        found = self.reached(i, others, threshold)
        return int(found[0]) if found.size else -1

    def matrix(self, threshold: int, block: int = 64) -> np.ndarray:
        """Which texts reach the threshold with which, as a square of booleans."""
        everyone = np.arange(len(self.texts))
        return np.concatenate(
            [self.grid(everyone[at : at + block], everyone, threshold) for at in range(0, len(everyone), block)]
            or [np.zeros((0, 0), dtype=bool)]
        )


class Keys:
    """Pairs (title, company) of one task in their order, compared with earlier leaders."""

    SQUARE = 2**13  # titles up to which ``assign`` keeps what it has compared, 64 MB

    def __init__(self, titles: list[str], companies: list[str], title_threshold: int, company_threshold: int) -> None:
        self.title, names = pd.factorize(np.array(titles, dtype=object))
        self.company, owners = pd.factorize(np.array(companies, dtype=object))
        self.titles, self.companies = TextSet(list(names)), TextSet(list(owners))
        self.title_threshold, self.company_threshold = title_threshold, company_threshold
        self._met: np.ndarray | None = None  # which titles reach which, as far as ``_done`` of the columns go
        self._done = np.zeros(len(names), dtype=bool)

    def _reach(self, mine: np.ndarray, theirs: np.ndarray) -> np.ndarray:
        """Which of ``mine`` (titles) reach which of ``theirs``; ``assign`` compares no two titles twice."""
        if self._met is None:
            return self.titles.grid(mine, theirs, self.title_threshold)
        new = theirs[~self._done[theirs]]
        if len(new):
            self._met[:, new] = self.titles.grid(np.arange(len(self._done)), new, self.title_threshold)
            self._done[new] = True
        return self._met[np.ix_(mine, theirs)]

    def grid(self, rows: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Which of ``rows`` match which of ``others``: titles first, companies where they reach."""
        mine, at = np.unique(self.title[rows], return_inverse=True)
        theirs, to = np.unique(self.title[others], return_inverse=True)
        hits = self._reach(mine, theirs)[at][:, to]
        a, b = np.nonzero(hits)
        own, to_own = np.unique(self.company[rows[a]], return_inverse=True)
        other, to_other = np.unique(self.company[others[b]], return_inverse=True)
        if 4 * len(a) > len(own) * len(other):  # most of them meet
            hits[a, b] = self.companies.grid(own, other, self.company_threshold)[to_own, to_other]
            return hits
        pairs, which = np.unique(
            self.company[rows[a]].astype(np.int64) * len(self.companies.texts) + self.company[others[b]], return_inverse=True
        )
        alike = self.companies.pairs(*np.divmod(pairs, max(1, len(self.companies.texts))), self.company_threshold)
        hits[a, b] = alike[which]
        return hits

    def first_of(self, rows: np.ndarray, leaders: np.ndarray) -> np.ndarray:
        """The first of ``leaders`` that each of ``rows`` matches, or -1.

        Leaders are met in slices of growing size; what has found its leader meets no more.
        """
        found = np.full(len(rows), -1, dtype=np.int64)
        left, start, step = np.argsort(self.title[rows], kind="stable"), 0, 64  # parts of few titles
        while start < len(leaders) and len(left):
            some = leaders[start : start + step]
            for part in np.array_split(left, max(1, len(left) * len(some) // 2**21)):
                hits = self.grid(rows[part], some)
                any_ = hits.any(axis=1)
                found[part[any_]] = some[hits[any_].argmax(axis=1)]
            left = left[found[left] < 0]
            start, step = start + step, min(step * 4, 4096)
        return found

    def assign(self, forced: np.ndarray, settled: np.ndarray, block: int = 256) -> tuple[np.ndarray, np.ndarray]:
        """(chosen, leads) of all rows in order: the first leader a row matches or the row itself.

        Forced rows lead whatever they match; settled ones have their leader already, so they
        only lead if they are forced.
        """
        n = len(self.title)
        chosen, leads = np.arange(n), np.zeros(n, dtype=bool)
        if len(self._done) <= self.SQUARE:
            self._met = np.zeros((len(self._done),) * 2, dtype=bool)
        leaders = np.empty(0, dtype=np.int64)
        for at in range(0, n, block):
            rows = np.arange(at, min(n, at + block))
            first = np.full(len(rows), -1, dtype=np.int64)
            asking = ~settled[rows]
            first[asking] = self.first_of(rows[asking], leaders)
            found = first >= 0
            chosen[rows[found]] = first[found]
            may_lead = np.flatnonzero((asking & ~found) | forced[rows])
            hits = self.grid(rows[may_lead], rows[may_lead]) if len(may_lead) else np.zeros((0, 0), dtype=bool)
            new: list[int] = []
            for k, r in enumerate(may_lead):
                if asking[r] and not found[r]:
                    earlier = np.flatnonzero(hits[k, new])
                    if len(earlier):
                        chosen[rows[r]] = rows[may_lead[new[earlier[0]]]]
                        if not forced[rows[r]]:
                            continue
                new.append(k)
            fresh = rows[may_lead[new]]
            leads[fresh] = True
            leaders = np.concatenate((leaders, fresh))
        return chosen, leads


class Near:
    """Which of ``n`` numbered names reach which, each name itself too: ``flat[start[i]:start[i + 1]]`` in order."""

    BITS = 2**14  # names up to which a table of bits answers ``holds``, 32 MB

    def __init__(self, n: int, a: np.ndarray, b: np.ndarray) -> None:
        """From the pairs ``a < b`` that reach the threshold."""
        own = np.arange(n, dtype=np.int64) * (n + 1)
        keys = np.concatenate((a.astype(np.int64) * n + b, b.astype(np.int64) * n + a, own))
        keys.sort()
        self.n = n
        self.start = np.searchsorted(keys, np.arange(n + 1, dtype=np.int64) * n)
        self.flat = (keys % max(1, n)).astype(np.int32)

    def __getstate__(self) -> dict:
        return {"n": self.n, "start": self.start, "flat": self.flat}

    def share(self) -> float:
        """The part of all names that a name reaches on average."""
        return len(self.flat) / max(1, self.n) ** 2

    def _table(self) -> np.ndarray:
        """``holds`` in bits, or its pairs as sorted numbers; made once in a process."""
        if not hasattr(self, "_made"):
            owner = np.repeat(np.arange(self.n, dtype=np.int64), np.diff(self.start))
            if self.n <= self.BITS:
                width = -(-self.n // 8)
                at = owner * width + (self.flat >> 3)
                bits = np.zeros(self.n * width, dtype=np.uint8)
                for k in range(8):
                    bits[at[(self.flat & 7) == k]] |= np.uint8(1 << k)
                self._made = bits
            else:
                self._made = owner * self.n + self.flat
        return self._made

    def holds(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the names ``a`` and ``b`` (one pair a place) reach the threshold."""
        table = self._table()
        if self.n <= self.BITS:
            width = np.int32(-(-self.n // 8))  # places stay below 2 ** 25
            return (table[a.astype(np.int32) * width + (b >> 3)] >> (b & 7).astype(np.uint8)) & 1 == 1
        keys = a.astype(np.int64) * self.n + b
        return table[np.minimum(np.searchsorted(table, keys), len(table) - 1)] == keys

    def components(self) -> np.ndarray:
        """The smallest name that each name is tied to, over any number of pairs."""
        label = np.arange(self.n)
        if not self.n:
            return label
        while True:
            low = np.minimum.reduceat(label[self.flat], self.start[:-1])
            low = np.minimum(low, low[low])
            if (low == label).all():
                return label
            label = low


def _runs(first: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places of all runs, one after the other, and where each run ends among them."""
    ends = np.cumsum(length)
    shift = (first - (ends - length)).astype(np.int32)
    return np.arange(ends[-1] if len(ends) else 0, dtype=np.int32) + np.repeat(shift, length), ends


def _split(sizes: np.ndarray, most: int, owner: np.ndarray | None = None) -> list[slice]:
    """Runs of entries that make about ``most`` together; those of one owner, in order, stay in one run."""
    ends = np.cumsum(sizes)
    if not len(ends) or ends[-1] <= most:
        return [slice(0, len(sizes))]
    cuts = np.searchsorted(ends, np.arange(most, ends[-1], most))
    if owner is not None:
        cuts = np.searchsorted(owner, owner[cuts])
    cuts = np.unique(np.concatenate(([0], cuts, [len(sizes)])))
    return [slice(int(a), int(b)) for a, b in zip(cuts, cuts[1:])]


class NearKeys:
    """``Keys`` over numbered names whose pairs are known: only rows of near names are met."""

    CHUNK = 2**18  # pairs looked at in one go
    OPEN = 128  # candidates a row that one slice of leaders brings on average

    def __init__(self, titles: np.ndarray, companies: np.ndarray, near_titles: Near, near_companies: Near) -> None:
        sides = [(titles.astype(np.int32), near_titles), (companies.astype(np.int32), near_companies)]
        # Rows meet by the names that reach fewer others; the other names decide.  Searches take longer than bits.
        sides.sort(key=lambda x: (x[1].share() * len(titles) + 1) * (1 if x[1].n > Near.BITS else 4))
        (self.name, self.near), (self.other, self.beside) = sides
        self.share = self.near.share()

    def _matches(self, rows: np.ndarray, others: np.ndarray):
        """(place in ``rows``, place in ``others``) of what matches, in pieces of whole rows, by rows."""
        names = self.name[others]
        order = np.argsort(names, kind="stable").astype(np.int32)
        beside = self.other[others][order]
        count = np.bincount(names, minlength=self.near.n).astype(np.int32)
        first = (np.cumsum(count) - count).astype(np.int32)
        start = self.near.start
        lists = start[self.name[rows]]
        degree = start[self.name[rows] + 1] - lists
        for part in _split(degree, self.CHUNK):
            places, ends = _runs(lists[part], degree[part])
            met = self.near.flat[places]
            held = count[met]
            some = np.flatnonzero(held)
            met, held = met[some], held[some]
            owner = np.searchsorted(ends, some, side="right").astype(np.int32) + np.int32(part.start)
            for piece in _split(held, self.CHUNK, owner):
                places, ends = _runs(first[met[piece]], held[piece])
                asking = np.repeat(self.other[rows[owner[piece]]], held[piece])
                hit = np.flatnonzero(self.beside.holds(asking, beside[places]))
                yield owner[piece][np.searchsorted(ends, hit, side="right")], order[places[hit]]

    def first_of(self, rows: np.ndarray, leaders: np.ndarray) -> np.ndarray:
        """The first of ``leaders`` that each of ``rows`` matches, or -1."""
        found = np.full(len(rows), -1, dtype=np.int64)
        left, start, step = np.arange(len(rows)), 0, max(64, int(self.OPEN / max(self.share, 1e-9)))
        while start < len(leaders) and len(left):
            some = leaders[start : start + step]
            for mine, theirs in self._matches(rows[left], some):
                if len(mine):
                    heads = np.flatnonzero(np.diff(mine, prepend=-1))
                    found[left[mine[heads]]] = some[np.minimum.reduceat(theirs, heads)]
            left = left[found[left] < 0]
            start, step = start + step, step * 4
        return found

    def assign(self, forced: np.ndarray, settled: np.ndarray, block: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """As ``Keys.assign``; a block is as large as the pairs within it allow."""
        n = len(self.name)
        block = block or min(2**16, max(256, int((2**23 / max(self.share, 1e-9)) ** 0.5)))
        chosen, leads = np.arange(n), np.zeros(n, dtype=bool)
        for at in range(0, n, block):
            rows = np.arange(at, min(n, at + block))
            asking = ~settled[rows]
            first = np.full(len(rows), -1, dtype=np.int64)
            if at:
                first[asking] = self.first_of(rows[asking], np.flatnonzero(leads[:at]))
            found = first >= 0
            chosen[rows[found]] = first[found]
            may_lead = rows[(asking & ~found) | forced[rows]]
            open_ = (asking & ~found)[may_lead - at]
            leads[may_lead] = True
            for mine, theirs in self._matches(may_lead, may_lead):
                earlier = (theirs < mine) & open_[mine]
                mine, theirs = mine[earlier], theirs[earlier]
                order = np.lexsort((theirs, mine))
                last = -1
                for r, lead in zip(may_lead[mine[order]].tolist(), may_lead[theirs[order]].tolist()):
                    if r != last and leads[lead]:
                        chosen[r], last = lead, r
                        leads[r] = forced[r]
        return chosen, leads


def _held(column: pd.Series) -> list[str]:
    return ["" if x is None else x for x in column]


def _set_of(a: pd.Series, b: pd.Series) -> tuple[TextSet, np.ndarray, np.ndarray]:
    """The different texts of two columns and their places."""
    places, names = pd.factorize(np.array(_held(a) + _held(b), dtype=object))
    return TextSet(list(names)), places[: len(a)], places[len(a) :]


@F.pandas_udf(DoubleType())
def _ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    texts, i, j = _set_of(a, b)
    total = texts.sizes[i] + texts.sizes[j]
    same = i == j
    shared = np.where(same, texts.sizes[i], 0)
    shared[~same] = texts.common(i[~same], j[~same])
    value = 100.0 * (1.0 - (total - 2 * shared) / np.maximum(total, 1))
    return pd.Series(np.where(total == 0, 100.0, value)).where((a.notna() & b.notna()).to_numpy())


@F.pandas_udf(BooleanType())
def _reaches(a: pd.Series, b: pd.Series, threshold: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="bool")
    texts, i, j = _set_of(a, b)
    return pd.Series(texts.pairs(i, j, int(threshold.iloc[0])))


def token_ratio(a: Column, b: Column) -> Column:
    """Ratio of two texts whose tokens are already sorted."""
    return _ratio(a, b)


def token_ratio_reaches(a: Column, b: Column, threshold: int) -> Column:
    return _reaches(a, b, F.lit(threshold))


def lengths_allow(len_a: Column, len_b: Column, threshold: int) -> Column:
    """The ratio cannot exceed 200 * min / (len1 + len2): a JVM-side bound."""
    return F.least(len_a, len_b) * 200 >= (len_a + len_b) * threshold

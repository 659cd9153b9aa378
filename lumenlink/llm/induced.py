"""External induced suffix sorting with common-prefix values.

The text is a run of symbols; 0 ends a piece and compares by place, so no
match crosses it. Suffixes are sorted as by induced sorting: the left-most
S-type (LMS) suffixes first, from these the L-type suffixes by an ascending
pass over first symbols, from these the S-type ones by a descending pass. A
sorted suffix hands its left neighbour, with the length of the prefix it shares
with the one before, to a priority queue ordered by first symbol; queues and
finished runs go to disk beyond a number of tuples. Common prefixes count up to
``cap`` only, and suffixes that agree that far are in any order.

The LMS suffixes are ranked on the reduced string (one symbol for each LMS
piece) by rank doubling, which reaches ``cap`` in few rounds, instead of by a
further recursion.
"""

from __future__ import annotations

import tempfile

import numpy as np


class DiskRuns:
    """Runs of (position, common prefix) by first symbol; the largest go to disk when too many tuples are held."""

    def __init__(self, folder: str, max_tuples: int):
        self.folder, self.max_tuples = folder, max_tuples
        self.runs: list[list] = [[] for _ in range(256)]
        self.size = [0] * 256
        self.held = self.spilled = 0

    def push(self, symbol: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.runs[symbol].append((pos, lcp))
        self.size[symbol] += len(pos)
        self.held += len(pos)
        while self.held > self.max_tuples:
            self._spill(max(range(256), key=self.size.__getitem__))

    def _spill(self, symbol: int) -> None:
        """What memory holds of a symbol becomes one file behind its earlier ones."""
        held = [run for run in self.runs[symbol] if isinstance(run, tuple)]
        f = tempfile.TemporaryFile(dir=self.folder)
        for part in zip(*held, strict=True):
            np.save(f, np.concatenate(part))
        self.runs[symbol] = [run for run in self.runs[symbol] if not isinstance(run, tuple)] + [f]
        self.held -= self.size[symbol]
        self.size[symbol] = 0
        self.spilled += 1

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray]:
        """All tuples of a symbol, in the order of arrival."""
        pos, lcp = [np.zeros(0, np.int64)], [np.zeros(0, np.uint8)]
        for run in self.runs[symbol]:
            if not isinstance(run, tuple):
                run.seek(0)
                with run as f:
                    run = (np.load(f), np.load(f))  # noqa: PLW2901
            pos.append(run[0])
            lcp.append(run[1])
        self.held -= self.size[symbol]
        self.runs[symbol], self.size[symbol] = [], 0
        return np.concatenate(pos), np.concatenate(lcp)


def _range_min(lcp: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For places at[k-1] < at[k]: the least of lcp over (at[k-1], at[k]]; the first value is 0."""
    out = np.zeros(len(at), lcp.dtype)
    if len(at) > 1:
        out[1:] = np.minimum.reduceat(lcp[: at[-1] + 1], at[:-1] + 1)
    return out


class Sorter:
    """Sorts the suffixes of ``t`` (uint8, last symbol 0) up to ``cap`` symbols."""

    def __init__(self, t: np.ndarray, cap: int, folder: str | None = None, max_tuples: int = 1 << 24):
        self.t, self.cap, self.n = t, cap, len(t)
        self.folder, self.max_tuples = folder, max_tuples
        n = self.n
        padded = np.concatenate([t, np.zeros(8, np.uint8)])
        self.words = np.ndarray(n, ">u8", padded.data, strides=(1,))  # the 8 symbols from each place on
        self._padded = padded
        ends = np.flatnonzero(t == 0)
        self.end_of = ends  # sorted places of the zeros

    def _left(self, pos: np.ndarray) -> np.ndarray:
        """Symbols from each place to the end of its piece."""
        return self.end_of[np.searchsorted(self.end_of, pos)] - pos

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Common prefix of suffix pairs, up to cap; it ends with either piece."""
        most = np.minimum(np.minimum(self._left(a), self._left(b)), self.cap)
        out = most.copy()
        live = np.flatnonzero(most > 0)
        off = 0
        while len(live):
            x = self.words[a[live] + off].astype(np.uint64) ^ self.words[b[live] + off].astype(np.uint64)
            diff = np.flatnonzero(x)
            if len(diff):
                # the highest differing byte: its place from the left
                high = np.frexp((x[diff] >> np.uint64(11)).astype(np.float64))[1]
                high = np.where(high > 0, high + 11, np.where(x[diff] > 255, 11, 8))
                out[live[diff]] = np.minimum(out[live[diff]], off + (64 - high) // 8)
            off += 8
            live = live[(x == 0)]
            live = live[most[live] > off]
        return out.astype(np.uint8)

    def _types(self) -> np.ndarray:
        """Which suffixes are S-type: less than the one to the right; runs of a symbol share a type."""
        t, n = self.t, self.n
        first = np.flatnonzero(np.r_[True, t[1:] != t[:-1]])
        symbol = t[first]
        kind = np.r_[symbol[:-1] < symbol[1:], False] | (symbol == 0)
        return np.repeat(kind, np.diff(np.r_[first, n]))

    def _sorted_lms(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """LMS places in the order of their suffixes, with common prefixes."""
        t, n = self.t, self.n
        lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
        if not len(lms) or t[lms[-1]] != 0:
            lms = np.append(lms, n - 1) if not len(lms) or lms[-1] != n - 1 else lms
        if t[0] == 0:
            lms = np.r_[0, lms] if lms[0] != 0 else lms
        # pieces of 7 symbols at most: longer LMS pieces are sampled again every 7 symbols
        gap = np.diff(np.r_[lms, n])
        gap[-1] = 1
        extra = (gap - 1) // 7 if len(gap) else gap
        extra[t[lms] == 0] = 0
        if extra.any():
            more = np.repeat(lms, extra) + 7 * (np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra) + 1)
            at = np.sort(np.concatenate([lms, more]))
        else:
            at = lms
        step = np.diff(np.r_[at, n])
        # key: the piece with the next LMS symbol, padded high (its end is S-type), or 7 symbols, padded low
        word = self.words[at].astype(np.uint64)
        is_lms = np.zeros(n + 1, bool)
        is_lms[lms] = True
        length = step + 1
        ended = (length <= 7) & is_lms[np.minimum(at + step, n)]
        keep = np.where(ended, length, 7)
        low = (np.uint64(1) << (np.uint64(64) - np.uint64(8) * keep.astype(np.uint64))) - np.uint64(1)
        key = np.where(ended, word | low, word & ~low)
        zero = t[at] == 0
        key[zero] = np.arange(int(zero.sum()), dtype=np.uint64)  # unique, below all others
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        rank = np.empty(len(at), np.int64)
        rank[order] = np.cumsum(np.r_[0, sorted_key[1:] != sorted_key[:-1]])
        m, hop, reach = len(at), 1, 2
        while reach < self.cap + 8 and rank[order[-1]] < m - 1:
            follow = np.full(m, -1, np.int64)
            follow[: m - hop] = rank[hop:]
            follow[rank < int(zero.sum())] = -1  # past the end of a piece nothing counts
            both = rank * (m + 1) + follow + 1
            order = np.argsort(both, kind="stable")
            sorted_key = both[order]
            rank = np.empty(m, np.int64)
            rank[order] = np.cumsum(np.r_[0, sorted_key[1:] != sorted_key[:-1]])
            hop *= 2
            reach *= 2
        out = at[order]
        out = out[is_lms[out]]
        lcp = np.zeros(len(out), np.uint8)
        if len(out) > 1:
            lcp[1:] = self.common(out[:-1], out[1:])
        return out, lcp

    def _waves(self, c: int, pos: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Add the suffixes that repeat the bucket's own symbol before those found so far, one symbol more in each wave."""
        t, cap = self.t, self.cap
        all_pos, all_lcp, k = [pos], [lcp], 1
        while len(pos):
            before = pos - 1
            at = np.flatnonzero((before >= 0) & (t[before] == c))
            if not len(at):
                break
            new_lcp = np.minimum(_range_min(lcp, at).astype(np.int64) + 1, cap).astype(np.uint8)
            new_lcp[0] = min(k, cap)
            pos, lcp = before[at], new_lcp
            all_pos.append(pos)
            all_lcp.append(lcp)
            k += 1
            if k > cap:  # what is left agrees in cap symbols: all at once
                rest = []
                for p in pos.tolist():
                    q = p
                    while q > 0 and t[q - 1] == c:
                        q -= 1
                    rest.append(np.arange(p - 1, q - 1, -1))
                tail = np.concatenate(rest)
                all_pos.append(tail)
                all_lcp.append(np.full(len(tail), cap, np.uint8))
                break
        return np.concatenate(all_pos), np.concatenate(all_lcp)

    def _hand_on(self, queue: DiskRuns, c: int, pos: np.ndarray, lcp: np.ndarray, up: bool) -> None:
        """Push the left neighbours whose symbol is above (or below) ``c``, by symbol and in order."""
        before = pos - 1
        symbol = self.t[before]
        at = np.flatnonzero((before >= 0) & ((symbol > c) if up else ((symbol < c) & (symbol > 0))))
        if not len(at):
            return
        symbol = symbol[at]
        order = np.argsort(symbol, kind="stable")
        cuts = np.flatnonzero(np.diff(symbol[order])) + 1
        for group in np.split(order, cuts):
            chosen = at[group]
            new = np.minimum(_range_min(lcp, chosen).astype(np.int64) + 1, self.cap).astype(np.uint8)
            new[0] = 1  # what came before is from another bucket: only this symbol is shared
            queue.push(int(symbol[group[0]]), before[chosen], new)

    def buckets(self):
        """Yield (positions, common prefix with the one before) of each first symbol, from the last symbol to 1."""
        t = self.t
        s = self._types()
        lms, lms_lcp = self._sorted_lms(s)
        first = t[lms]
        starts = np.searchsorted(first, np.arange(257))
        queue, left = DiskRuns(self.folder, self.max_tuples), DiskRuns(self.folder, self.max_tuples)
        for c in range(256):
            pos, lcp = queue.pop(c)
            if len(pos):
                lcp[0] = 0
                pos, lcp = self._waves(c, pos, lcp)
                left.push(c, pos, lcp)
            a, b = starts[c], starts[c + 1]
            if b > a:
                own_lcp = lms_lcp[a:b].copy()
                own_lcp[0] = self.common(pos[-1:], lms[a : a + 1])[0] if len(pos) and c else 0
                if c == 0:
                    own_lcp[:] = 0
                pos, lcp = np.concatenate([pos, lms[a:b]]), np.concatenate([lcp, own_lcp])
            if len(pos):
                self._hand_on(queue, c, pos, lcp, up=True)
        del lms, lms_lcp
        queue = DiskRuns(self.folder, self.max_tuples)
        for c in range(255, 0, -1):
            pos, lcp = queue.pop(c)  # descending
            if len(pos):
                lcp[0] = 0
                pos, lcp = self._waves(c, pos, lcp)
            l_pos, l_lcp = left.pop(c)
            if not len(pos) and not len(l_pos):
                continue
            seam = self.common(pos[-1:], l_pos[-1:])[0] if len(pos) and len(l_pos) else 0
            down_lcp = np.r_[np.uint8(seam), l_lcp[:0:-1]].astype(np.uint8) if len(l_pos) else l_lcp
            self._hand_on(queue, c, np.concatenate([pos, l_pos[::-1]]), np.concatenate([lcp, down_lcp]), up=False)
            up_lcp = np.r_[np.uint8(seam), lcp[:0:-1]].astype(np.uint8) if len(pos) else lcp
            yield np.concatenate([l_pos, pos[::-1]]), np.concatenate([l_lcp, up_lcp])

    def repeated(self) -> np.ndarray:
        """Which places start a string of ``cap`` symbols that starts elsewhere, too."""
        out = np.zeros(self.n, bool)
        for pos, lcp in self.buckets():
            hit = np.flatnonzero(lcp >= self.cap)
            out[pos[hit]] = True
            out[pos[hit - 1]] = True
        return out

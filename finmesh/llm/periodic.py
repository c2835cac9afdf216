"""Periodic runs of words by longest common extensions over a difference cover (operator 13).

A run is a stretch of words with least period q (words q apart are equal), at least ``max(min_length, 2 q)``
long, that no neighbour extends.  In a run the positions i with word[i] = word[i + q] are a zone of
at least g = max(q, min_length - q) words, so one of them is a multiple of g.  For every q the grid of the
multiples of g (a harmonic series, n log n in all) is tested for equal words, and each hit is widened by
the longest common extension of i and i + q to the right and to the left.  Stretches met under
several periods keep the least, which is theirs (Fine and Wilf).

Longest common extension of i and j: of the positions only those in a difference cover (0, 1, 3, 9 modulo 13) are
sorted as suffixes.  A few words are compared, at most 13, up to a shift at which both positions
lie in the cover; from there the answer is the least of a stretch of the table of common prefixes of
neighbours in sorted order, by a sparse table.  Sorting goes by the first 13 words, then doubles; the
cover repeats, so the next block of a sampled suffix is a sampled suffix.  The index is
made when the first comparison gets as far as the samples.

Nulls count as empty; texts of any length are worked on whole (memory in proportion to the words of one text).
Every row is judged by itself, so repeated rows, ties and null ids need no rule.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CYCLE, COVER = 13, (0, 1, 3, 9)      # fixed values: a difference cover, every difference modulo 13 occurs
GRID = 1 << 18                       # grid points tested at a time
QUERIES = 1 << 16                    # extensions compared at a time
SMALL = 2048                         # words of a text whose grid is looked up
ROWS = 256                           # rows handed on at a time
RUNS = "array<struct<start: long, length: long, period: long>>"


@cache
def _shifts():
    """shift[x, y]: the least k at which x + k and y + k both lie in the cover."""
    import numpy as np
    return np.array([[next(k for k in range(CYCLE) if (x + k) % CYCLE in COVER and (y + k) % CYCLE in COVER) for y in range(CYCLE)] for x in range(CYCLE)])


class Extensions:
    """Longest common extensions of positions of an array of word numbers."""

    def __init__(self, words):
        import numpy as np
        self.n = len(words)
        self.words = np.concatenate([words, np.full(CYCLE + 1, -1, words.dtype)])
        self.table = None

    def query(self, i, j):
        """How many words agree from i and j on (arrays, i < j <= n)."""
        import numpy as np
        out = np.empty(len(i), np.int64)
        for at in range(0, len(i), QUERIES):
            out[at:at + QUERIES] = self._query(i[at:at + QUERIES], j[at:at + QUERIES])
        return out

    def _query(self, i, j):
        import numpy as np
        out = self._compared(i, j)
        far = np.flatnonzero(out == CYCLE)
        if len(far):
            if self.table is None:
                self._build()
            i, j = i[far], j[far]
            shift = _shifts()[i % CYCLE, j % CYCLE]
            out[far] = shift + self._sampled(i + shift, j + shift)
        return out

    def _compared(self, i, j):
        """The first words that differ, ``CYCLE`` if none of so many does."""
        import numpy as np
        step, last = np.arange(CYCLE), len(self.words) - 1
        same = np.ones((len(i), CYCLE + 1), bool)
        same[:, :CYCLE] = self.words[np.minimum(i[:, None] + step, last)] == self.words[np.minimum(j[:, None] + step, last)]
        same[:, CYCLE] = False
        return same.argmin(axis=1)

    def _build(self):
        import numpy as np
        starts = (np.arange(0, self.n, CYCLE)[:, None] + np.array(COVER)).ravel()
        starts = starts[starts < self.n]
        size, per = len(starts), len(COVER)

        def ranked(order, changes):
            rank = np.empty(size, np.int64)
            rank[order] = np.r_[0, np.cumsum(changes)]
            return rank

        blocks = self.words[starts[:, None] + np.arange(CYCLE)]
        order = np.lexsort(blocks.T[::-1])
        ranks = [ranked(order, (blocks[order[1:]] != blocks[order[:-1]]).any(axis=1))]
        del blocks
        step = per
        while ranks[-1].max() + 1 < size:                  # by twice as many blocks
            following = np.zeros(size, np.int64)
            following[:max(0, size - step)] = ranks[-1][step:] + 1
            key = ranks[-1] * (size + 1) + following
            order = np.argsort(key, kind="stable")
            ranks.append(ranked(order, key[order[1:]] != key[order[:-1]]))
            step *= 2
        # common prefixes of neighbours: whole blocks by the ranks of each level, then single words
        a, b, common = order[:-1].copy(), order[1:].copy(), np.zeros(max(0, size - 1), np.int64)
        for level in range(len(ranks) - 1, -1, -1):
            inside = (a < size) & (b < size)
            same = inside & (ranks[level][np.minimum(a, size - 1)] == ranks[level][np.minimum(b, size - 1)])
            common += same * (CYCLE << level)
            a += same * (per << level)
            b += same * (per << level)
        place = lambda k: k // per * CYCLE + np.array(COVER)[k % per]
        for at in range(0, len(common), QUERIES):
            common[at:at + QUERIES] += self._compared(place(a[at:at + QUERIES]), place(b[at:at + QUERIES]))
        self.rank = ranked(order, np.ones(max(0, size - 1), bool))
        rows = [np.r_[0, common].astype(np.int32)]
        while 2 << len(rows) - 1 <= size:
            half = 1 << len(rows) - 1
            row = rows[-1].copy()
            row[:-half] = np.minimum(rows[-1][:-half], rows[-1][half:])
            rows.append(row)
        self.table = np.stack(rows)

    def _sampled(self, i, j):
        """The same for positions of the cover."""
        import numpy as np
        which = np.zeros(CYCLE, np.int64)
        which[list(COVER)] = range(len(COVER))
        x, y = (self.rank[k // CYCLE * len(COVER) + which[k % CYCLE]] for k in (i, j))
        lo, hi = np.minimum(x, y) + 1, np.maximum(x, y)
        level = np.frexp(hi - lo + 1)[1] - 1
        return np.minimum(self.table[level, lo], self.table[level, hi + 1 - (1 << level)])


@cache
def _small_grid(min_length: int):
    """(least n, i, q) of the grid points of texts of up to ``SMALL`` words, in order of the least n."""
    import numpy as np
    q, i = (np.concatenate(x) for x in zip(*((np.full(len(r), p), r) for p in range(1, SMALL // 2 + 1)
                                             for r in [np.arange(0, SMALL - p, max(p, min_length - p))])))
    least = np.maximum(i + q + 1, 2 * q)
    order = np.argsort(least, kind="stable")
    return least[order], i[order], q[order]


def _grid(n: int, min_length: int):
    """(i, q): for every period the positions at which a zone is looked for."""
    import numpy as np
    if n <= SMALL:
        least, i, q = _small_grid(min_length)
        points = np.searchsorted(least, n, side="right")
        yield i[:points], q[:points]
        return
    p = 1
    while p <= n // 2:
        # as many periods as make GRID points
        last = min(n // 2, p + max(0, GRID * max(p, min_length - p) // n))
        periods = np.arange(p, last + 1)
        gap = np.maximum(periods, min_length - periods)
        points = -(-(n - periods) // gap)
        q = np.repeat(periods, points)
        number = np.arange(len(q)) - np.repeat(np.cumsum(points) - points, points)
        yield number * np.repeat(gap, points), q
        p = last + 1


def runs(words, min_length: int = 12):
    """(start, length, period) of all runs, as rows in order of start and period, of an array of word numbers."""
    import numpy as np
    n = len(words)
    found = [np.empty((0, 3), np.int64)]
    if n >= min_length:
        right, left = Extensions(words), Extensions(words[::-1])
        for i, q in _grid(n, min_length):
            hit = np.flatnonzero(words[i] == words[i + q])
            i, q = i[hit], q[hit]
            ahead = right.query(i, i + q)
            behind = left.query(n - i - q, n - i)
            run = ahead + behind >= np.maximum(q, min_length - q)
            found.append(np.unique(np.stack([i - behind, ahead + behind + q, q], axis=1)[run], axis=0))
    rows = np.unique(np.concatenate(found), axis=0)                    # by start, length, period
    if len(rows):
        rows = rows[np.r_[True, (rows[1:, :2] != rows[:-1, :2]).any(axis=1)]]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapse(words: list, found) -> list:
    """The words less all that a run holds after its first period."""
    import numpy as np
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, found[:, 0] + found[:, 2], 1)
    np.add.at(depth, found[:, 0] + found[:, 1], -1)
    keep = np.cumsum(depth[:-1]) == 0
    return [words[k] for k in np.flatnonzero(keep)] if not keep.all() else words


def detect(df: DataFrame, min_length: int = 12, rewrite: Callable | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, runs, collapsed) of each row: its runs by start and period, and its words without the repeats,
    joined by spaces.  ``rewrite(id, words) -> words`` may change the words (UTF-8) of a text beforehand."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                sizes, rows, texts = [0], [], []
                for key, text in zip(part.column(0).to_pylist(), part.column(1)):
                    words = (text.as_py() or "").encode().split()
                    if rewrite is not None:
                        words = rewrite(key, words)
                    number = {w: k for k, w in enumerate(dict.fromkeys(words))}
                    found = runs(np.fromiter(map(number.__getitem__, words), np.int32, len(words)), min_length)
                    sizes.append(len(found))
                    rows.append(found)
                    texts.append(b" ".join(collapse(words, found)).decode())
                columns = np.concatenate(rows).T
                structs = pa.StructArray.from_arrays([pa.array(c) for c in columns], names=["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), structs)
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "runs", "collapsed"])
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed string")


def repeated_stretch(key, words: list) -> list:
    """Of one text in ten (by the crc32 of its id) the words from some point on, replaced by a stretch of them over and over."""
    import zlib
    n, h = len(words), 1 if key is None else zlib.crc32(str(key).encode())
    if h % 10 or not n:
        return words
    g = h // 10
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    stretch = words[start:start + period]
    return words[:start] + (stretch * (-(-(n - start) // period)))[:n - start]


def digests(found: DataFrame) -> DataFrame:
    """The runs of ``detect`` as counts, the longest run, and digests."""
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))), "")
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"),
                        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, period = -F.col("longest.length"), F.col("longest.period")
    return rows.select("doc_id", "n_runs", F.col("longest.start").alias("start"), length.alias("length"), period.alias("period"),
                       F.expr("-1000 * longest.length div longest.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")

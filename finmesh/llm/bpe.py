"""Byte-level BPE encoding and decoding (operator 1).

Merging is done by Spark higher-order functions over the byte arrays of distinct
words, with the rank map as an array literal; decoding concatenates the binary
pieces of the ids.

Two passes, and text is never shuffled:

1. Each task hands on the distinct words of its documents; the words that most tasks have,
   ``FREQUENT`` at most, are folded once and broadcast (a bounded dictionary, a few tens of MB).
2. Every document row carries the positions of its words in that dictionary, which goes
   on growing along the task, plus the byte arrays of the words it is the first to use
   (dictionary encoding, as in a Parquet page).  Spark folds only those rarer words; the next
   step appends their ids to the same dictionary and gathers the document's ids.  A task's own
   part of the dictionary holds ``MAX_WORDS`` words at most and then starts anew, so memory is
   bounded whatever a task reads.

The rank map is keyed by a pair of ids.  Spark looks a map literal up by scanning it,
so the literal is laid out as a table of displaced rows: two array reads for a pair.

Nulls count as the empty text; an empty text gives no ids; repeated rows are kept.
"""
from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from finmesh.llm.common import hex_sha256, stored

FREQUENT = 1_400_000       # words folded once for all tasks and broadcast, at most
SHORT_WORD = 64            # bytes; longer words are not broadcast
MAX_WORDS = 600_000        # further words of a task at which its own part starts anew
LONG_WORD = 1024           # bytes; folding costs the square of a word's length, longer words use a heap
NONE = 65536               # "no such pair" (ids are below)
EDGE = 65535               # guard at either end of a word
ID_BITS = 17

# The public tokenizers' pattern, and the same over the characters below U+0100
# (letters, numbers and white space of Latin-1 written out; the first alternatives exclude each other).
PUBLIC = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_L, _N, _S = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
LATIN_1 = f" ?[{_L}]+| ?[{_N}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+"


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge_pairs(ranks: dict[bytes, int]) -> dict[int, int]:
    """(left id << 16 | right id) -> id of the joined bytes, for every split of every token."""
    if max(ranks.values()) >= EDGE:
        raise ValueError("ids must be below 65535")
    out = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            left, right = ranks.get(token[:i]), ranks.get(token[i:])
            if left is not None and right is not None:
                out[left << 16 | right] = rank
    return out


class RankTable:
    """All pairs in one array: the row of a left id is laid into free slots at a displacement,
    so that slot = displacement[left] + right, and an entry holds its left id and the joined id."""

    def __init__(self, pairs: dict[int, int]):
        import numpy as np
        keys = np.sort(np.fromiter(pairs, dtype=np.int64, count=len(pairs)))
        lefts, starts = np.unique(keys >> 16, return_index=True)
        rows = sorted(zip(lefts.tolist(), np.split(keys & 65535, starts[1:])), key=lambda r: -len(r[1]))
        self.displacement = np.zeros(NONE, dtype=np.int64)
        entries = np.full(4 * NONE + 2 * len(pairs), NONE << 16, dtype=np.int64)       # no left id's
        used, low = np.zeros(len(entries), dtype=bool), 0
        for left, rights in rows:
            first = int(rights[0])
            while used[low]:
                low += 1
            for lo in range(max(low, first), len(entries), 4096):      # the first free slots where the whole row fits
                at = np.flatnonzero(~used[lo:lo + 4096]) + lo - first
                at = at[(at >= 0) & (at + rights[-1] < len(entries))]
                for right in rights[1:]:
                    if not len(at):
                        break
                    at = at[~used[at + right]]
                if len(at):
                    self.displacement[left] = at[0]
                    used[at[0] + rights] = True
                    for right in rights.tolist():
                        entries[at[0] + right] = left << 16 | pairs[left << 16 | right]
                    break
            else:
                raise ValueError("the pairs do not fit")
        self.entries = entries[:int(self.displacement.max()) + NONE]

    def rank(self, t: Column, left: Column, right: Column) -> Column:
        """The joined id, or NONE and more where the entry is of another left id (its bits then differ above the lowest 16)."""
        slot = F.get(t["displacement"], left.cast("int")) + right
        return F.get(t["entries"], slot.cast("int")).bitwiseXOR(F.shiftleft(left, 16))


def _longs(values) -> Column:
    """An array literal (folded once by the optimizer)."""
    return F.split(F.lit(",".join(map(str, values.tolist()))), ",").cast("array<bigint>")


def _let(value: Column, body) -> Column:
    return F.transform(F.array(value), body)[0]


def fold_words(words: Column, ranks: dict[bytes, int], table: RankTable | None = None) -> Column:
    """array<array<smallint>> (byte arrays of words) -> array<array<int>> (ids of each).

    A word's state is an array with an entry for each id between two guards (the rank of the
    pair it begins above ``ID_BITS``, the id below), and the place of the pair to merge next
    (0: to be found).  Steps alternate: one finds the leftmost pair of least rank, the next
    merges it and ranks its two new neighbours."""
    table = table or RankTable(merge_pairs(ranks))
    edge = F.array(F.lit(EDGE).cast("bigint"))
    of_byte = F.split(F.lit(",".join(str(ranks[bytes([b])]) for b in range(256))), ",").cast("array<bigint>")

    def entry(rank, own):
        return F.shiftleft(rank, ID_BITS) + own

    def own(entries, at):
        return F.get(entries, at).bitwiseAND((1 << ID_BITS) - 1)

    def start(t, word):
        ids = F.concat(edge, F.transform(word, lambda b: F.get(t["of_byte"], b.cast("int"))), edge)
        return _let(ids, lambda x: F.struct(F.zip_with(x, F.slice(x, 2, F.size(x)), lambda a, b: entry(
            F.coalesce(table.rank(t, a, b), F.lit(NONE).cast("bigint")), a)).alias("x"), F.lit(0).alias("at")))    # the last id has no neighbour

    def step(t, s):
        x, at = s["x"], s["at"]
        joined = F.shiftright(F.get(x, at - 1), ID_BITS)
        left = own(x, at - 2)
        find = F.struct(x.alias("x"), F.array_position(x, F.array_min(x)).cast("int").alias("at"))
        merge = F.struct(F.concat(F.slice(x, 1, at - 2), F.array(entry(table.rank(t, left, joined), left),
                                                                entry(table.rank(t, joined, own(x, at + 1)), joined)),
                                  F.slice(x, at + 2, LONG_WORD + 2)).alias("x"), F.lit(0).alias("at"))
        return F.when(at == 0, find).when(joined < NONE, merge).otherwise(s)

    def fold(t, word):
        steps = F.when(F.size(word) > 1, F.sequence(F.lit(3), F.size(word) * 2)).otherwise(F.array().cast("array<int>"))
        return F.aggregate(steps, start(t, word), lambda s, _: step(t, s), lambda s: F.transform(
            F.slice(s["x"], 2, F.size(s["x"]) - 2), lambda e: e.bitwiseAND((1 << ID_BITS) - 1).cast("int")))

    literal = F.struct(_longs(table.displacement).alias("displacement"), _longs(table.entries).alias("entries"), of_byte.alias("of_byte"))
    return _let(literal, lambda t: F.transform(words, lambda w: fold(t, w)))


def splitter(pattern: str):
    """The function that splits a text by ``pattern``.  For the public pattern, texts of Latin-1 characters
    take the same pattern with its classes written out, which the standard library matches faster."""
    import re

    import regex
    find = regex.compile(pattern).findall
    if pattern != PUBLIC:
        return find
    latin = re.compile(LATIN_1).findall

    def split(text):
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return find(text)
        return latin(text)
    return split


def merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a long word: merges off a heap over a linked list (n log n)."""
    parts: list = [word[i:i + 1] for i in range(len(word))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    heap = [(ranks[word[i:i + 2]], i, word[i:i + 2]) for i in range(len(parts) - 1) if word[i:i + 2] in ranks]
    heapq.heapify(heap)

    def push(i):
        j = after[i]
        if j < len(parts) and (joined := parts[i] + parts[j]) in ranks:
            heapq.heappush(heap, (ranks[joined], i, joined))

    while heap:
        _, i, joined = heapq.heappop(heap)
        if parts[i] is None or after[i] >= len(parts) or parts[i] + parts[after[i]] != joined:
            continue                                   # one of the two has been merged meanwhile
        j = after[i]
        parts[i], parts[j], after[i] = joined, None, after[j]
        if after[j] < len(parts):
            before[after[j]] = i
        push(i)
        if before[i] >= 0:
            push(before[i])
    return [ranks[p] for p in parts if p is not None]


def encode(df: DataFrame, ranks: dict[bytes, int], pattern: str, text_col: str = "text", id_col: str = "doc_id",
           frequent: int = FREQUENT) -> DataFrame:
    """Rows (id, ids array<int>, ids_sha256), one for each row of ``df``."""
    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    table = RankTable(merge_pairs(ranks))
    known, *ids = _frequent_words(texts, ranks, table, pattern, frequent)
    known = dict(zip(known, range(len(known))))                    # made once for a worker, not for each of its tasks
    known, ids = (texts.sparkSession.sparkContext.broadcast(x) for x in (known, ids))      # a step's workers load what it needs
    words = texts.mapInArrow(_words(pattern, ranks, known), "doc_id long, fresh boolean, places binary, words array<array<smallint>>, merged array<array<int>>")
    folded = words.select("doc_id", "fresh", "places", "merged", fold_words(F.col("words"), ranks, table).alias("folded"))
    return folded.mapInArrow(_gather(ids), "doc_id long, ids array<int>, ids_sha256 string")


def _frequent_words(texts: DataFrame, ranks: dict[bytes, int], table: RankTable, pattern: str, most: int) -> tuple[list[str], bytes, bytes]:
    """(words, their ids as int32, ids of each as int32) of the words that most tasks have."""
    import numpy as np

    def distinct(batches: Iterator) -> Iterator:
        import pyarrow as pa
        find, seen = splitter(pattern), set()
        for batch in batches:
            for text in batch.column(0):
                seen.update(find(text.as_py()))
                if len(seen) > MAX_WORDS:
                    yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], names=["word"])
                    seen = set()
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], names=["word"])

    counted = stored(texts.select("text").mapInArrow(distinct, "word string").groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(
        f"n > 1 and octet_length(word) <= {SHORT_WORD}"), "bpe-words")
    by_n = {r.n: r.words for r in counted.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()}     # a row for each number of tasks
    total, least = 0, None
    for n in sorted(by_n, reverse=True):
        if total + by_n[n] > most:
            break
        total, least = total + by_n[n], n
    if least is None:
        return [], b"", b""
    folded = counted.where(F.col("n") >= least).select("word").mapInArrow(_byte_arrays, "words array<string>, bytes array<array<smallint>>").select(
        "words", fold_words(F.col("bytes"), ranks, table).alias("ids")).toArrow()
    words, ids, lens = [], [], []
    for batch in folded.to_batches():
        words += batch.column(0).flatten().to_pylist()
        each = batch.column(1).flatten()
        ids.append(each.flatten().to_numpy())
        lens.append(each.value_lengths().to_numpy())
    return words, np.concatenate(ids).astype(np.int32).tobytes(), np.concatenate(lens).astype(np.int32).tobytes()


def _byte_arrays(batches: Iterator) -> Iterator:
    """Words in rows of up to 512, with their byte arrays."""
    import numpy as np
    import pyarrow as pa
    for batch in batches:
        for lo in range(0, batch.num_rows, 512):
            words = batch.column(0).slice(lo, 512).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(np.array([0, len(words)], np.int32), pa.array(words, pa.string())),
                                              pa.ListArray.from_arrays(np.array([0, len(words)], np.int32), _bytes_of([w.encode() for w in words]))], names=["words", "bytes"])


def _bytes_of(words: list[bytes]):
    import numpy as np
    import pyarrow as pa
    ends = np.r_[0, np.cumsum([len(w) for w in words])].astype(np.int32)
    return pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(words), dtype=np.uint8).astype(np.int16)))


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """Binary text of an array of ids: its pieces (a literal, a character below U+0100 for each byte) one after another."""
    by_id = {rank: token for token, rank in ranks.items()}
    pieces = F.split(F.lit("\u0100".join(by_id.get(i, b"").decode("latin-1") for i in range(max(by_id) + 1))), "\u0100")
    return F.encode(_let(pieces, lambda p: F.array_join(F.transform(ids, lambda i: F.get(p, i)), "")), "ISO-8859-1")


def _words(pattern: str, ranks: dict[bytes, int], base):
    """Step 1: split each text; positions of its words in the task's dictionary, and the words new to it."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        find, known = splitter(pattern), _KnownAfter(base.value)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                fresh, places, counts, words = [], [], [], []
                for text in part.column(1):
                    if renew := known.own > MAX_WORDS:
                        known = _KnownAfter(base.value)
                    fresh.append(renew)
                    found = find(text.as_py())
                    places.append(np.fromiter(map(known.__getitem__, found), dtype=np.int32, count=len(found)).tobytes())
                    counts.append(len(known.added))
                    words += [w.encode() for w in known.added]
                    known.added.clear()
                merged = [merge_long(w, ranks) if len(w) > LONG_WORD else None for w in words]
                words = [b"" if len(w) > LONG_WORD else w for w in words]
                rows = np.r_[0, np.cumsum(counts)].astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array(fresh, pa.bool_()), pa.array(places, pa.binary()),
                    pa.ListArray.from_arrays(rows, _bytes_of(words)),
                    pa.ListArray.from_arrays(rows, pa.array(merged, pa.list_(pa.int32())))],
                    names=["doc_id", "fresh", "places", "words", "merged"])
    return run


class _Known(dict):
    """word -> place; ``added`` has the words that came since it was last cleared."""

    def __init__(self):
        super().__init__()
        self.added: list[str] = []

    def __missing__(self, word):
        self.added.append(word)
        self[word] = place = len(self)
        return place


class _KnownAfter(_Known):
    """The same after the words of ``base``, which keep their places.  A word of ``base`` is looked up there once, so ``base`` is
    never copied; ``own`` counts the others."""

    def __init__(self, base: dict[str, int]):
        super().__init__()
        self.base, self.own = base, 0

    def __missing__(self, word):
        place = self.base.get(word)
        if place is None:
            place = len(self.base) + self.own
            self.own += 1
            self.added.append(word)
        self[word] = place
        return place


def _gather(base):
    """Step 2: the same dictionary, now with ids, and each document's ids."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        flat, lens = base.value
        flat, ends = np.frombuffer(flat, np.int32), np.r_[0, np.cumsum(np.frombuffer(lens, np.int32))].astype(np.int64)
        n_flat, n = start = len(flat), len(ends) - 1
        flat, ends = _room(flat, n_flat, 1 << 16), _room(ends, n + 1, 1 << 12)
        steps = np.arange(1 << 15)
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                docs, shas = [], []
                for row in range(part.num_rows):
                    if part.column(1)[row].as_py():
                        n_flat, n = start
                    folded, merged = part.column(4)[row].values, part.column(3)[row].values
                    if folded is not None and len(folded):
                        lens, values = folded.value_lengths().to_numpy(zero_copy_only=False), folded.flatten().to_numpy()
                        if merged.null_count < len(merged):
                            own = [m if (m := merged[i].as_py()) is not None else folded[i].as_py() for i in range(len(folded))]
                            lens, values = np.array([len(x) for x in own]), np.array([y for x in own for y in x], np.int32)
                        flat, ends = _room(flat, n_flat, len(values)), _room(ends, n + 1, len(lens))
                        flat[n_flat:n_flat + len(values)] = values
                        ends[n + 1:n + 1 + len(lens)] = n_flat + np.cumsum(lens)
                        n_flat, n = n_flat + len(values), n + len(lens)
                    places = np.frombuffer(part.column(2)[row].as_buffer(), dtype=np.int32).astype(np.int64)
                    starts = ends[places]
                    lens = ends[places + 1] - starts
                    stops = np.cumsum(lens)
                    size = int(stops[-1]) if len(stops) else 0
                    at = np.repeat(starts - stops + lens, lens)
                    at += steps[:size] if size <= len(steps) else np.arange(size)
                    ids = flat[at]
                    docs.append(ids)
                    shas.append(hex_sha256(ids.astype("<u4", copy=False)))
                offsets = np.r_[0, np.cumsum([len(x) for x in docs])].astype(np.int32)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(docs).astype(np.int32, copy=False))),
                    pa.array(shas, pa.string())], names=["doc_id", "ids", "ids_sha256"])
    return run


def _room(buffer, used: int, more: int):
    import numpy as np
    while used + more > len(buffer):
        buffer = np.concatenate([buffer, np.empty((max(len(buffer), more), *buffer.shape[1:]), buffer.dtype)])
    return buffer

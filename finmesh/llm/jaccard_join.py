"""N-gram Jaccard join by parity sketches (operator 4).

A document is the set of its distinct w-word shingles (64-bit hashes).  Two documents link
when 100 * intersection >= percent * union; that needs sizes within percent of each other and a
symmetric difference of at most D = (100 - percent) / (100 + percent) * (size + size).

Sketch: a shingle toggles one bit of one of K chunks.  Bits that differ between two
sketches are at most the shingles that differ, so of K > D chunks at least K - D are equal: pairs
that link agree in a whole chunk (pigeonhole), and chunks become join keys.  D belongs to a
band of sizes; a document also takes part in the next band where its partners can lie
there.  Chunks have 2^32 bits, kept sparse: the key is an XOR of one random word for each bit that
is set, which toggles just as the bits do.  A chunk without shingles would be a key that many
share; K exceeds D by so much that a document hardly ever has K - D empty chunks, and
only such a document uses its empty chunks as keys as well, so no link is lost.

Shingles that many documents have (license lines, quoted passages) are left out of the
sketches: without them two sets differ in no more shingles, so the bound holds, and no key is made
of nothing but such a passage.  A document with at most D chunks of other shingles uses the
sketch of its whole set as well.

Hot groups: each task keeps one document of equal sets and, for each key, hands on only its
least document and links the others to it, so a key reaches the shuffle once per block of a
task, whatever share of the rows has it.  A block's keys travel sorted and packed, one row per slice
of the key space (``KEY_BITS`` bits of a key; two keys that are equal in those only cost a comparison).
Slices hold about ``SLICE`` keys, so their number grows with the input.  After the shuffle the
documents of a key are linked to its least document.  These links (linear in the rows) are verified on the full sets and joined into
components.  Documents that share keys form clusters.  Of a cluster that still holds several
components, those documents drop out that their own shingles alone keep from any link; in each
key the densest document is compared with the others, round by round while that merges components;
at last the pairs that share a key, still lie in different components and whose short sketches (``SHORT`` words
of 64 bits, compared within the join) differ little enough are verified.  Pairs
within a component cannot change the result and are not listed, so copies are never expanded
into all pairs.

The result is exact but for collisions of 64-bit shingle hashes within a pair (odds below 1e-9 for
documents of 100,000 words) and of 128-bit set digests.

Documents without words (null, empty, white space) have the empty set and link with
nothing; with fewer than w words the whole sequence is one shingle.  Rows that repeat an id
are one node; null ids link with nothing and get a null component.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmesh.llm.common import ASCII_LOWER, stored
from finmesh.llm.components import component_of, connected, joined

BLOCK = 1 << 19          # sketch rows a task gathers before it links the documents of equal keys
MEMO = 1 << 17           # word hashes a task remembers
SLICE = 1 << 20          # packed rows of a slice, about
KEY_BITS = 56            # bits of a key that are shuffled
FILTER_BITS = 26         # size of the bitmap of candidate documents (8 MB), whatever the input
SAMPLE = 8_000           # documents in which common shingles are looked for, about
OFTEN, MAX_COMMON = 4, 500_000
SKETCH = 2048            # bits of the sketch that pairs are first compared by
SHORT = 8                # 64-bit words of the sketch that the last join compares
MAX_ROUNDS = 4           # of comparing with the densest document before all pairs of a key are listed
ROW = "key long, a long, kind byte, b long"
PLACE = f"shiftrightunsigned(xxhash64(id), {64 - FILTER_BITS})"
PACKED = f"place long, {ROW}, keys binary, ids binary"
DOC, SAME, TREE, LEADER = 0, 1, 2, 3


class Bands:
    """Size bands [edge, next edge) and, for each, the number of chunks and the bound D."""

    def __init__(self, percent: int):
        if not 0 < percent <= 100:
            raise ValueError("percent must lie in 1 to 100")
        self.percent, self.edges, self.chunks, self.bound = percent, [1], [], []

    def band(self, size: int) -> int:
        import bisect
        while self.edges[-1] <= size:
            self._grow()
        return bisect.bisect_right(self.edges, size) - 1

    def _grow(self):
        import math
        low = self.edges[-1]
        top = max(low + 1, math.ceil(low * (100 / self.percent) ** 2))
        d = 2 * (top - 1) * (100 - self.percent) // (100 + self.percent)
        least = max(1, math.ceil(low * self.percent / 100))           # the smallest guest
        k = d + 1
        while d:                                                      # room for empty chunks: four deviations
            empty = k * math.exp(-least / k)
            if k - d > empty + 4 * math.sqrt(empty) or k >= 3 * (d + 1):
                break
            k += 1
        self.edges.append(top)
        self.chunks.append(k)
        self.bound.append(d)

    def schemes(self, size: int) -> list[int]:
        """The size's own band, and the next if a partner can lie there."""
        own = self.band(size)
        return [own, own + 1] if size * 100 // self.percent >= self.edges[own + 1] else [own]

    def prepare(self, scheme: int):
        while len(self.chunks) <= scheme:
            self._grow()
        return self.chunks[scheme], self.bound[scheme]


def _mix(x):
    """A 64-bit finaliser (splitmix64) over an array."""
    import numpy as np
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word):
        import xxhash
        if len(self) >= MEMO:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_hashes(text: str | None, width: int, memo: dict):
    """Distinct shingle hashes, in order."""
    import numpy as np
    words = (text or "").encode().translate(ASCII_LOWER).split()
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(memo.__getitem__, words), dtype=np.uint64, count=n)
    k = min(width, n)
    total = np.zeros(n - k + 1, dtype=np.uint64)
    for i in range(k):
        total = _mix(total + h[i:n - k + 1 + i] + np.uint64(0x9E3779B97F4A7C15 * (i + 1) % (1 << 64)))
    return np.unique(total + np.uint64(k))


def sketch_keys(hashes, bands: Bands, common=None, frequent=None):
    """Join keys (as signed longs) of a set; ``common``: sorted shingles left out of the sketches, ``frequent``: sorted
    keys that come last in the order of keys."""
    import numpy as np
    rare = hashes
    if common is not None and len(common):
        rare = hashes[~_among(hashes, common)]
    keys = []
    for scheme in bands.schemes(len(hashes)):
        chunks, bound = bands.prepare(scheme)
        found = _ordered(_chunk_keys(rare, chunks, scheme)[1], frequent)
        keys.append(found[:bound + 1])
        if len(found) > bound:
            continue
        # Too few chunks of rare shingles.  With a partner that has enough of them it shares one of these; a
        # partner that has too few as well has, like this set, the sketch of its whole set, empty chunks last.
        own, found = _chunk_keys(hashes, chunks, scheme + 100)
        found = _ordered(found, frequent)[:bound + 1]
        keys.append(found)
        if len(found) <= bound:
            absent = np.setdiff1d(np.arange(chunks, dtype=np.uint64), own)
            keys.append(np.sort(_mix(absent + np.uint64(scheme + 1 << 40) + np.uint64(0xA0761D6478BD642F)))[:bound + 1 - len(found)])
    return np.concatenate(keys).view(np.int64)


def _among(values, known):
    """Which of the values are in a sorted array."""
    import numpy as np
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _ordered(keys, frequent):
    """The keys in the order that all sets share: by value, frequent ones last."""
    import numpy as np
    keys = np.sort(keys)
    if frequent is None or not len(frequent):
        return keys
    last = _among(keys, frequent)
    return np.concatenate([keys[~last], keys[last]])


def _chunk_keys(hashes, chunks: int, scheme: int):
    """The chunks that have shingles, and the key of each."""
    import numpy as np
    if not len(hashes):
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    chunk = (hashes >> np.uint64(32)) % np.uint64(chunks)
    bit = _mix((hashes & np.uint64(0xFFFFFFFF)) + (chunk << np.uint64(32)) + np.uint64(scheme << 56))
    order = np.argsort(chunk, kind="stable")
    own, starts = np.unique(chunk[order], return_index=True)
    value = np.bitwise_xor.reduceat(bit[order], starts)
    return own, _mix(value + (own + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((scheme + 1) * 0xD6E8FEB86659FD93 % (1 << 64)))


def _planes(values) -> bytes:
    """Unsigned longs as planes of bytes, as many planes as the greatest needs."""
    import numpy as np
    width = max(1, (int(values.max()).bit_length() + 7) // 8)
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data, n: int):
    import numpy as np
    out = np.zeros((n, 8), np.uint8)
    out[:, :len(data) // n] = np.frombuffer(data, np.uint8).reshape(-1, n).T
    return out.view(np.uint64).ravel()


def _packed(keys, values, shift: int):
    """(slice, [base of values], number of rows, packed columns) for each slice of sorted keys (unsigned, ``KEY_BITS`` bits)
    with columns of ``values`` (signed longs); a slice is ``key >> shift``."""
    import numpy as np
    place = keys >> np.uint64(shift)
    edges = np.flatnonzero(np.r_[True, place[1:] != place[:-1], True]) if len(keys) else np.zeros(1, int)
    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist()):
        first = place[lo] << np.uint64(shift)
        bases = [int(v[lo:hi].min()) for v in values]
        planes = [_planes(np.diff(keys[lo:hi], prepend=first))]
        planes += [_planes(v[lo:hi].view(np.uint64) - np.int64(base).view(np.uint64)) for v, base in zip(values, bases)]
        yield int(place[lo]), bases, hi - lo, planes


def _unpacked(place: int, bases, n: int, planes, shift: int):
    """The keys and columns of a row of ``_packed``."""
    import numpy as np
    first = np.uint64(place) << np.uint64(shift)
    return [np.cumsum(_from_planes(planes[0], n)) + first] + [
        (_from_planes(data, n) + np.int64(base).view(np.uint64)).view(np.int64) for base, data in zip(bases, planes[1:])]


def _shift(rows: float) -> int:
    """The shift from a key to its slice, for so many packed rows: 16 slices at least."""
    return KEY_BITS - max(4, int(rows / SLICE).bit_length())


def _led(keys, ids):
    """Rows of keys in order: (keys, ids, first of its key, least id of its key, another than the least)."""
    import numpy as np
    order = np.lexsort((ids, keys))
    keys, ids = keys[order], ids[order]
    head = np.r_[True, keys[1:] != keys[:-1]] if len(keys) else np.zeros(0, bool)
    least = ids[head][np.cumsum(head) - 1]
    return keys, ids, head, least, ids != least


def _often(texts: DataFrame, width: int, made) -> "np.ndarray":  # noqa: F821
    """Values of ``made(hashes)`` that many documents of a sample have, sorted (at most ``MAX_COMMON``).  Which they
    are changes no result, only the order of keys and what sketches leave out."""
    import numpy as np

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        memo = _Hashes()
        for batch in batches:
            found = [np.unique(made(shingle_hashes(t.as_py(), width, memo))) for t in batch.column(0)]
            value, n = np.unique(np.concatenate(found or [np.empty(0, np.uint64)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), pa.array(n.astype(np.int64))], names=["value", "n"])

    often = texts.select("text").mapInArrow(run, "value long, n long").groupBy("value").agg(F.sum("n").alias("n")).where(f"n >= {OFTEN}")
    rows = often.orderBy(F.desc("n"), "value").limit(MAX_COMMON).select("value").toArrow()
    return np.sort(rows.column(0).to_numpy().view(np.uint64))


def _common(texts: DataFrame, width: int, percent: int):
    """Of a sample of the documents: shingles that many have, and join keys (made without those) that many have; and
    about how many keys all documents have (a key for eight bytes; it only sets the number of slices)."""
    fraction = min(1.0, SAMPLE / max(1, texts.count()))
    sample = stored(texts.select("text").sample(fraction=fraction, seed=11), "jaccard-sample")
    size = sample.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    common = _often(sample, width, lambda hashes: hashes)

    def keys(hashes):
        import numpy as np
        bands = Bands(percent)
        rare = hashes[~_among(hashes, common)] if len(common) else hashes
        made = [_chunk_keys(part, bands.prepare(scheme)[0], scheme + extra)[1] for scheme in (bands.schemes(len(hashes)) if len(hashes) else [])
                for part, extra in ((rare, 0), (hashes, 100))]
        return np.concatenate(made) if made else np.empty(0, np.uint64)
    return common, _often(sample, width, keys), size / 8 / fraction


def _scan(width: int, percent: int, common, frequent, shift: int):
    """Rows (kind, key, a, b, keys, ids): DOC (id in a, set size in b), SAME (equal sets), TREE (key, least, other), and
    LEADER: the keys of a block that lie in a slice with the least document of each.  ``place`` is the slice of LEADER
    rows and spreads the others."""
    def run(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa
        bands, memo, first = Bands(percent), _Hashes(), {}
        often, last = np.frombuffer(common.value, np.uint64), np.frombuffer(frequent.value, np.uint64)
        held: list = []
        count = seen = 0

        def rows(kind, key, a, b, place=None, keys=None, ids=None):
            nonlocal seen
            n = len(a)
            if place is None:
                place = (np.arange(seen, seen + n) * 0x9E3779B1 & (1 << KEY_BITS) - 1) >> shift
                seen += n
            none = [None] * n
            return pa.RecordBatch.from_arrays([
                pa.array(place, pa.int64()), pa.array(key, pa.int64()), pa.array(a, pa.int64()), pa.array(np.full(n, kind, np.int8)), pa.array(b, pa.int64()),
                pa.array(keys or none, pa.binary()), pa.array(ids or none, pa.binary())], names=["place", "key", "a", "kind", "b", "keys", "ids"])

        def flush():
            nonlocal held, count
            keys, ids, head, least, other = _led(np.concatenate([k for k, _ in held]), np.repeat(np.array([i for _, i in held], np.int64), [len(k) for k, _ in held]))
            held, count = [], 0
            yield rows(TREE, keys[other].view(np.int64), least[other], ids[other])
            parts = list(_packed(keys[head], [ids[head]], shift))
            for lo in range(0, len(parts), 256):
                place, bases, sizes, planes = zip(*parts[lo:lo + 256])
                yield rows(LEADER, place, [x for x, in bases], sizes, place, [x for x, _ in planes], [y for _, y in planes])

        for batch in batches:
            docs: list = []
            same: list = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                hashes = shingle_hashes(text.as_py(), width, memo)
                docs.append((doc_id, len(hashes)))
                if doc_id is None or not len(hashes):
                    continue
                if len(first) >= MEMO:
                    first.clear()
                known = first.setdefault(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest(), doc_id)
                if known != doc_id:
                    same.append((known, doc_id))
                    continue
                held.append((np.unique(sketch_keys(hashes, bands, often, last).view(np.uint64) >> np.uint64(64 - KEY_BITS)), doc_id))
                count += len(held[-1][0])
                if count >= BLOCK:
                    yield from flush()
            if docs:
                yield rows(DOC, [0] * len(docs), [d for d, _ in docs], [n for _, n in docs])
            if same:
                yield rows(SAME, [0] * len(same), [a for a, _ in same], [b for _, b in same])
        if held:
            yield from flush()
    return run


def _met(shift: int):
    """The rows of a slice (``ROW``): keys of all blocks meet, and each document of a key is linked to its least."""
    def run(rows):
        import numpy as np
        import pyarrow as pa
        packed = rows.column("kind").to_numpy() == LEADER
        others = rows.filter(pa.array(~packed)).select(["key", "a", "kind", "b"])
        found = [_unpacked(r["key"], [r["a"]], r["b"], (r["keys"], r["ids"]), shift) for r in rows.filter(pa.array(packed)).to_pylist()]
        if not found:
            return others
        keys, ids, _, least, other = _led(*map(np.concatenate, zip(*found)))
        tree = pa.table([pa.array(keys[other].view(np.int64)), pa.array(least[other]), pa.array(np.full(other.sum(), TREE, np.int8)), pa.array(ids[other])],
                        names=["key", "a", "kind", "b"])
        return pa.concat_tables([others, tree])
    return run


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))


def _bitmap(ids: DataFrame):
    """A broadcast bitmap of the places of ``ids``, of the same size whatever the input."""
    bits = ids.select(F.expr(PLACE).alias("place")).groupBy(F.shiftright("place", 15).alias("block")).agg(
        F.expr("bitmap_construct_agg(place & 32767)").alias("bits"))
    # at most 2^11 rows of 4 KB reach the driver
    bitmap = bytearray(1 << FILTER_BITS - 3)
    for row in bits.toLocalIterator():
        bitmap[row.block << 12:row.block + 1 << 12] = row.bits
    return ids.sparkSession.sparkContext.broadcast(bytes(bitmap))


def _marked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ``ids``, and a few others by collision (more of them the larger the input): what a
    join by id would drop stays out of its shuffle."""
    candidates, names = _bitmap(ids), rows.columns

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        bits = np.frombuffer(candidates.value, dtype=np.uint8)
        for batch in batches:
            at = batch.column(batch.num_columns - 1).to_numpy().astype(np.int64)
            yield batch.take(pa.array(np.flatnonzero(bits[at >> 3] >> (at & 7) & 1))).select(names)
    return rows.withColumn("place", F.expr(PLACE)).mapInArrow(run, rows.schema)


def _sets(ids: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """(id, n, sketch, hashes, s0, s1, ...) of the documents ``ids``: shingle sets made anew, and parity sketches of
    ``SKETCH`` bits and of ``SHORT`` longs.

    Nothing is shuffled: a bitmap of bounded size passes the candidates, and a few others by collision (more of them the
    larger the input), which later joins by id leave aside."""
    candidates = _bitmap(ids)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        bits, memo = np.frombuffer(candidates.value, dtype=np.uint8), _Hashes()
        for batch in batches:
            at = batch.column(2).to_numpy().astype(np.int64)
            keep = np.flatnonzero(bits[at >> 3] >> (at & 7) & 1)
            for lo in range(0, len(keep), 256):
                own = keep[lo:lo + 256]
                found = [shingle_hashes(batch.column(1)[int(i)].as_py(), width, memo) for i in own]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(pa.array(own)), pa.array([len(x) for x in found], pa.int64()),
                    pa.array([_sketch(x) for x in found], pa.binary()), pa.array([x.tobytes() for x in found], pa.binary()),
                    *map(pa.array, np.frombuffer(b"".join(_sketch(x, 64 * SHORT) for x in found), np.int64).reshape(-1, SHORT).T)],
                    names=["id", "n", "sketch", "hashes", *words])

    hashed = texts.select("id", "text", F.expr(PLACE).alias("place")).where("id is not null")
    words = [f"s{i}" for i in range(SHORT)]
    return stored(hashed.mapInArrow(run, "id long, n long, sketch binary, hashes binary, " + ", ".join(f"{w} long" for w in words)), "jaccard-sets")


def _sketch(hashes, bits: int = SKETCH) -> bytes:
    import numpy as np
    return np.packbits(np.bincount(hashes >> np.uint64(64 - bits.bit_length() + 1), minlength=bits).astype(np.uint8) & 1).tobytes()


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) for each of ``pairs``: first by the Hamming distance of the sketches, which is at
    most the symmetric difference, then on the full sets of the pairs that it lets pass."""
    def near(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            x, y = (np.frombuffer(b"".join(c.to_pylist()), np.uint8).reshape(batch.num_rows, SKETCH // 8) for c in (batch.column(4), batch.column(5)))
            n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            distance = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            passes = (distance * (100 + percent) <= (100 - percent) * (n + m)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(passes, pa.bool_())], names=["a", "b", "near"])

    def compare(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(x) + len(y) - len(np.unique(np.concatenate([x, y])))
                linked.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(linked, pa.bool_())], names=["a", "b", "linked"])

    def with_both(rows, sets, *columns):
        left, right = (sets.select(F.col("id").alias(v), *[F.col(c).alias(f"{c}_{v}") for c in columns]) for v in "ab")
        return rows.join(left, "a").join(right, "b").select("a", "b", *[f"{c}_{v}" for c in columns for v in "ab"])

    first = stored(with_both(pairs, sets, "n", "sketch").mapInArrow(near, "a long, b long, near boolean"), "jaccard-near")
    passed = first.where("near").select("a", "b").distinct()
    full = _marked(sets.select("id", "hashes"), passed.select(F.explode(F.array("a", "b")).alias("id")))
    result = with_both(passed, full, "hashes").mapInArrow(compare, "a long, b long, linked boolean")
    return stored(result.unionByName(first.where("not near").select("a", "b", F.lit(False).alias("linked"))).groupBy("a", "b").agg(
        F.max("linked").alias("linked")), "jaccard-verified")


def _open(docs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of ``docs`` (v, c, cluster) those that may still link with a document of their cluster in another
    component: (v, c, cluster, n, u).

    A shingle that only one component has is in no intersection with another's.  With u such
    shingles of n, a link to a document of m shingles needs n - u >= percent * (n + m) /
    (100 + percent); m is at least the least size in the cluster, and percent of n.  Copies with many changes of
    their own drop out here, each by itself, before any pair is listed.  First half of the shingles are looked at, which
    finds no more than u; all of them only for the documents that stay, the only ones that can still link."""
    docs = _narrowed(docs, sets, percent, 2)
    return docs if docs.isEmpty() else _narrowed(docs, sets, percent, 1)


def _narrowed(docs: DataFrame, sets: DataFrame, percent: int, share: int) -> DataFrame:
    """One pass of ``_open`` over the shingles divisible by ``share``."""
    ids = docs.select(F.col("v").alias("id"), "c")
    own = sets.select("id", "n").join(ids, "id")
    shift = _shift((own.agg(F.sum("n")).first()[0] or 0) / share)
    names, row = ["place", "v", "c", "n", "shingles", "vs", "cs"], "place long, v long, c long, n long, shingles binary, vs binary, cs binary"

    def pack(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        held: list = []

        def flush():
            shingles = np.concatenate([x for _, _, x in held])
            v, c = (np.repeat(np.array([h[k] for h in held], np.int64), [len(x) for _, _, x in held]) for k in (0, 1))
            order = np.argsort(shingles)
            parts = list(_packed(shingles[order], [v[order], c[order]], shift))
            held.clear()
            for lo in range(0, len(parts), 256):
                place, bases, sizes, planes = zip(*parts[lo:lo + 256])
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in (place, *zip(*bases), sizes)), *(pa.array(x, pa.binary()) for x in zip(*planes))], names=names)

        count = 0
        for batch in batches:
            for v, c, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                shingles = np.frombuffer(data.as_buffer(), np.uint64)
                shingles = shingles[shingles % np.uint64(share) == 0] >> np.uint64(64 - KEY_BITS)
                if len(shingles):
                    held.append((v, c, shingles))
                    count += len(shingles)
                if count >= BLOCK:
                    yield from flush()
                    count = 0
        if held:
            yield from flush()

    def alone(rows):
        import numpy as np
        import pyarrow as pa
        found = [_unpacked(r["place"], [r["v"], r["c"]], r["n"], (r["shingles"], r["vs"], r["cs"]), shift) for r in rows.to_pylist()]
        shingles, v, c = map(np.concatenate, zip(*found))
        order = np.argsort(shingles)
        shingles, v, c = shingles[order], v[order], c[order]
        starts = np.flatnonzero(np.r_[True, shingles[1:] != shingles[:-1]])
        single = np.repeat(np.minimum.reduceat(c, starts) == np.maximum.reduceat(c, starts), np.diff(np.r_[starts, len(c)]))
        v, u = np.unique(v[single], return_counts=True)
        return pa.table([pa.array(v), pa.array(u.astype(np.int64))], names=["v", "u"])

    full = _marked(sets.select("id", "hashes"), ids).join(ids, "id").select("id", "c", "hashes")
    count = full.mapInArrow(pack, row).groupBy("place").applyInArrow(alone, "v long, u long").groupBy("v").agg(F.sum("u").alias("u"))
    sizes = own.groupBy(F.col("id").alias("v")).agg(F.max("n").alias("n"), F.min("n").alias("low"), F.count(F.lit(1)).alias("rows"))
    shaped = stored(docs.select("v", "c", "cluster").join(sizes, "v").join(count, "v", "left").select("v", "c", "cluster", "n", "low", F.when(
        F.col("rows") == 1, F.coalesce("u", F.lit(0))).otherwise(0).alias("u")), "jaccard-shapes")       # repeated ids: no bound
    least = shaped.groupBy("cluster").agg(F.min("low").alias("m"))
    kept = shaped.join(least, "cluster").where(f"{100 * (100 + percent)} * (n - u) >= {percent} * (100 * n + greatest(100 * m, {percent} * n))")
    return stored(_mixed(kept.select("v", "c", "cluster", "n", "u")), "jaccard-open")


def _mixed(docs: DataFrame) -> DataFrame:
    """The rows of clusters that hold several components."""
    several = docs.groupBy("cluster").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("cluster")
    return docs.join(several, "cluster", "left_semi")


def components(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row."""
    texts = _texts(df, id_col, text_col)
    *often, size = _common(texts, width, percent)
    common, frequent = (texts.sparkSession.sparkContext.broadcast(found.tobytes()) for found in often)
    shift = _shift(size)
    rows = stored(texts.mapInArrow(_scan(width, percent, common, frequent, shift), PACKED).groupBy("place").applyInArrow(_met(shift), ROW), "jaccard-rows")
    tree = rows.where(f"kind = {TREE}")
    same = rows.where(f"kind = {SAME}").select("a", "b")
    pairs = stored(tree.select("a", "b").distinct(), "jaccard-pairs")
    sets = _sets(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct(), texts, width)
    digests = sets.where("n > 0").select("id", F.md5("hashes").alias("digest"))       # empty sets link with nothing
    same = stored(same.unionByName(digests.join(digests.groupBy("digest").agg(F.min("id").alias("a")), "digest").where("a <> id").select(
        "a", F.col("id").alias("b"))).distinct(), "jaccard-same")
    checked = _verify(pairs, sets, percent)
    comp = stored(connected(same.unionByName(checked.where("linked").select("a", "b"))), "jaccard-components")
    # documents that share keys, directly or through others, form a cluster; a link lies inside one
    cluster = connected(pairs).select("v", F.col("c").alias("cluster"))
    docs = stored(_mixed(component_of(cluster, comp, "v", "c")), "jaccard-docs")
    docs, helps = _open(docs, sets, percent), True
    for round_no in range(MAX_ROUNDS + 1):
        if docs.isEmpty():
            break
        members = stored(tree.select("key", F.col("a").alias("v")).unionByName(tree.select("key", F.col("b").alias("v"))).join(
            docs.drop("cluster"), "v").distinct(), "jaccard-members")
        per_key = members.groupBy("key", "c").agg(F.count(F.lit(1)).alias("n")).groupBy("key").agg(
            F.sum("n").alias("size"), F.sum(F.col("n") * F.col("n")).alias("own"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
        total = per_key.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n"), F.coalesce(F.sum((F.col("size") * F.col("size") - F.col("own")) / 2), F.lit(0.0)).alias("cross")).first()
        if not total.n:
            break
        members = members.join(per_key.select("key", "size"), "key")
        last = round_no == MAX_ROUNDS or not helps or total.cross <= 8 * total.n
        if last:
            # repeated ids have no size or sketch of their own and are compared without
            words = [f"s{i}" for i in range(SHORT)]
            short = sets.groupBy(F.col("id").alias("v")).agg(F.count(F.lit(1)).alias("rows"), *[F.min(w).alias(w) for w in words]).select(
                "v", "rows", *[F.when(F.col("rows") == 1, F.col(w)).alias(w) for w in words])
            sketched = stored(members.join(short, "v").withColumn("n", F.when(F.col("rows") == 1, F.col("n"))).drop("rows"), "jaccard-sketched")
            x, y = (sketched.select("key", *[F.col(k).alias(f"{k}_{v}") for k in ("v", "c", "n", "u", *words)]) for v in "12")
            x, y = (t.withColumnsRenamed({f"{k}_{v}": f"{k}{v}" for k in "vcnu"}) for t, v in ((x, 1), (y, 2)))
            differ = " + ".join(f"bit_count({w}_1 ^ {w}_2)" for w in words)
            could = [f"coalesce({100 + percent} * (n{i} - u{i}) >= {percent} * (n1 + n2), true)" for i in (1, 2)]
            could.append(f"coalesce({100 + percent} * ({differ}) <= {100 - percent} * (n1 + n2), true)")
            pairs = x.join(y, "key").where(" and ".join(["v1 < v2", "c1 <> c2", *could])).select(F.col("v1").alias("a"), F.col("v2").alias("b"))
        else:
            weight = members.groupBy("v").agg(F.sum("size").alias("weight"))
            densest = members.join(weight, "v").groupBy("key").agg(F.max_by(F.struct("v", "c"), F.struct("weight", F.xxhash64("v", F.lit(round_no)))).alias("d"))
            pairs = members.join(densest, "key").where("c <> d.c").select(F.least("v", "d.v").alias("a"), F.greatest("v", "d.v").alias("b"))
        new = stored(pairs.distinct().join(checked.select("a", "b"), ["a", "b"], "left_anti"), "jaccard-pairs")
        verified = _verify(new, sets, percent)
        helps = not verified.where("linked").isEmpty()
        checked = stored(checked.unionByName(verified), "jaccard-checked")
        if helps:
            comp = stored(joined(comp, verified.where("linked").select("a", "b")), "jaccard-components")
        if last:
            break
        docs = stored(_mixed(component_of(docs.drop("c"), comp, "v", "c")), "jaccard-docs")
    docs = rows.where(f"kind = {DOC}").select(F.col("a").alias("doc_id"), F.col("b").alias("n_shingles"))
    out = docs.join(comp.select(F.col("v").alias("doc_id"), F.col("c").alias("component_id")), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))

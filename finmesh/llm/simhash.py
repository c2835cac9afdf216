"""SimHash near duplicates by multi-index hashing (operator 12).

A document's fingerprint has 64 bits; a bit is set if over half the XXH64 hashes of its shingles, repeats
included, have it.  Equal fingerprints are one vertex; two vertices link when at most ``distance`` bits differ.

Multi-index: fingerprints are cut into ``segments``.  Of two that differ in ``distance`` = r * segments + a bits, one of
the first a + 1 segments differs in at most r bits, or one of the others in at most r - 1.  Each segment
has a table of the fingerprints by the segment's value, and each fingerprint probes it with all values
of that Hamming ball around its own; what it meets is verified on all bits.  With a distance of 2 and two
segments: a ball of one bit in the upper half, the very value in the lower half.  Of two values
that differ, the one that has the highest differing bit set does the probing, so a pair is met once a table.

Hot values: a group of near copies fills few values of a segment, and its matches would grow with the
square of the group.  The fingerprints of a value with more than ``MATCHES`` matches take a finer table instead: its
keys are whole fingerprints with all bits of a ball of radius ceil(distance / 2) turned.  Two
fingerprints within the distance share such a key, and a key is shared by no more fingerprints than its
ball has members, whatever the input; those are verified against the least of them, and
against each other where the ball is wider than the distance.  No link is lost either way.

Documents without words (null, empty, white space) have fingerprint zero and link like any other; with fewer
than w words the whole sequence is one shingle.  The vertices are fingerprints, so rows that repeat an id are
judged each by its text; null ids have the component of their fingerprint, and count for none.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from finmesh.llm.common import ASCII_LOWER, stored
from finmesh.llm.components import connected

BITS = 64
MATCHES = 64             # matches of one value of a segment that are still listed
HASHED = 50_000          # hashes whose bits are counted at a time


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """The fingerprint of a text, unsigned."""
    from itertools import repeat

    import numpy as np
    import xxhash
    words = (text or "").encode().translate(ASCII_LOWER).split()
    if not words:
        return 0
    k = min(width, len(words))
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[:len(words) - k + 1]
    hashed = np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, starts.tolist(), ends[k - 1:].tolist())), repeat(seed)), "<u8", len(starts))
    ones = np.zeros(BITS, np.int64)
    for at in range(0, len(hashed), HASHED):
        ones += np.unpackbits(hashed[at:at + HASHED].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashed), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, width: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, print) of each row; ``print`` is the fingerprint as a signed long."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), width, seed) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64), pa.int64())], names=["id", "print"])
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, print long")


def ball(lo: int, hi: int, radius: int) -> list[int]:
    """All masks of at most ``radius`` of the bits lo..hi-1."""
    return [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(lo, hi), r)]


def _long(mask: int) -> str:
    """An unsigned mask as an SQL literal of a signed long."""
    return "shiftleft(1L, 63)" if mask == 1 << BITS - 1 else f"{mask - (mask >> BITS - 1 << BITS)}L"


def segment_balls(distance: int, segments: int) -> list[tuple[int, int, int]]:
    """(first bit, end, radius) of each segment that is probed, from the uppermost down."""
    radius, rest = divmod(distance, segments)
    edges = [BITS * k // segments for k in range(segments + 1)]
    spans = list(zip(edges, edges[1:]))[::-1]
    radii = [radius if k <= rest else radius - 1 for k in range(segments)]
    return [(lo, hi, r) for (lo, hi), r in zip(spans, radii) if r >= 0]


def links(prints: DataFrame, distance: int = 2, segments: int = 2, matches: int = MATCHES) -> DataFrame:
    """(a, b) of distinct fingerprints (``print``) that differ in at most ``distance`` bits: not every pair, but
    enough that the components are those of all pairs."""
    near = f"bit_count(a ^ b) <= {distance}"
    tables = []
    for number, (lo, hi, radius) in enumerate(segment_balls(distance, segments)):
        own = f"print & {_long((1 << hi) - (1 << lo))}"
        # (mask, its highest bit): the side with that bit set probes
        probes = ", ".join(f"struct({_long(m)} AS mask, {_long(1 << m.bit_length() >> 1)} AS top)" for m in ball(lo, hi, radius))
        rows = prints.select("print", F.expr(f"inline(array({probes}))")).where("mask = 0 or print & top <> 0")
        tables.append(rows.select(F.lit(number).cast("byte").alias("table"), F.expr(f"({own}) ^ mask").alias("value"), "print", F.expr("mask = 0").alias("entry")))
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    rows = stored(rows, "simhash-tables")
    sizes = rows.groupBy("table", "value").agg(F.count(F.lit(1)).alias("probes"), F.sum(F.col("entry").cast("long")).alias("entries"))
    # the very value is in the table and probes it; a value met by nothing but itself has one probe
    sizes = stored(sizes.where("probes > 1 and entries > 0").select("table", "value", (F.col("probes") * F.col("entries") > matches).alias("hot")), "simhash-values")
    cold, hot = sizes.where("not hot").select("table", "value"), sizes.where("hot").select("table", "value")
    listed = rows.join(cold, ["table", "value"], "left_semi")
    held = listed.where("entry").select("table", "value", F.col("print").alias("a"))
    probing = listed.select("table", "value", F.col("print").alias("b"), "entry")
    few = held.join(probing, ["table", "value"]).where("(not entry or a < b)").where(near).select("a", "b")
    many = stored(rows.join(hot, ["table", "value"], "left_semi").select("print").distinct(), "simhash-hot")
    return few.unionByName(_by_balls(many, distance))


def _by_balls(prints: DataFrame, distance: int) -> DataFrame:
    """(a, b) as ``links``, by the keys of the whole ball of half the distance."""
    radius = -(-distance // 2)
    turned = prints.select(F.col("print").alias("b"), F.expr(f"explode(array({', '.join(map(_long, ball(0, BITS, radius)))})) AS mask"))
    keyed = turned.select("b", F.expr("b ^ mask").alias("key"))
    if distance % 2:                         # members of a ball may be further apart than the distance: compare all of its few members
        other = keyed.select("key", F.col("b").alias("a"))
        return keyed.join(other, "key").where("a < b").where(f"bit_count(a ^ b) <= {distance}").select("a", "b")
    least = F.min("b").over(Window.partitionBy("key"))
    return keyed.select("b", least.alias("a")).where("a <> b").where(f"bit_count(a ^ b) <= {distance}").select("a", "b")


def components(df: DataFrame, width: int = 3, distance: int = 2, segments: int = 2, id_col: str = "doc_id", text_col: str = "text",
               matches: int = MATCHES) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row: the fingerprint in hexadecimal, and the least id reachable."""
    docs = stored(fingerprints(df, width, id_col=id_col, text_col=text_col), "simhash-prints")
    prints = stored(docs.groupBy("print").agg(F.min("id").alias("least")), "simhash-distinct")
    linked = stored(connected(links(prints.select("print"), distance, segments, matches)), "simhash-components")
    # the least id of each fingerprint's component; only fingerprints with links need the two further joins
    inside = prints.join(linked.withColumnRenamed("v", "print"), "print")
    least = inside.groupBy("c").agg(F.min("least").alias("component_id"))
    classes = prints.join(linked.select(F.col("v").alias("print")), "print", "left_anti").select("print", F.col("least").alias("component_id")).unionByName(
        inside.join(least, "c").select("print", "component_id"))
    classes = stored(classes, "simhash-classes")
    return docs.join(classes, "print").select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), BITS // 4, "0")).alias("fingerprint"), "component_id")

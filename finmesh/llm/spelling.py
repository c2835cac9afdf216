"""Spelling variants by a bit-sliced position index (operator 11).

Two words are near if one inserted, deleted or replaced code point makes them equal.  The index holds,
for each (position, letter), the bitset of the words that have the letter there.  A word is looked up
by a recurrence over its letters that moves all words of the index along at once, 64 and more to a
machine word: one set of the words that agree so far (no error) and one of those with one error so
far; replaced letters read the same position of the index, inserted and deleted ones the
position shifted by one.

The index is dealt out by pigeonhole.  Let p be the length of the common prefix of two near words and s
the length of the shorter: the words agree before p and, but for one letter, after it.  A *hole*
[lo, hi) of the positions 0..s gathers the words of lengths s and s + 1 that agree before lo and behind
hi; p lies in exactly one of the halves of [0, s), so every near pair meets in exactly one hole of a
level.  A hole of more than ``LIMIT`` words is halved again, level by level, down to one
position: such a hole has at most as many words as the alphabet has letters and pairs of letters, so no group
grows with the input.  Holes are independent, and the slices of one span only its own positions.

Words are sorted by falling count inside a hole, so the least bit of a result is the most frequent near
word.  Null texts have no words; a null id is written as nothing before the colon.  Rows that repeat an
id or a text count each.  Words of any length are looked up whole.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmesh.llm.common import ASCII_LOWER, stored

LETTERS = "a-zÀ-ÿ"
COUNTED = 300_000        # distinct words a task holds before it hands on its partial counts
LIMIT = 2048             # words of a hole that is not halved again


def vocabulary(df: DataFrame, min_length: int = 5, min_count: int = 3, rewrite: Callable | None = None,
               id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): runs of letters, A-Z lower-cased, of at least ``min_length`` code points and ``min_count`` occurrences.

    ``rewrite(id, run) -> word`` may change a run before it is counted; it must not make it longer."""
    def run(batches: Iterator) -> Iterator:
        import re
        from collections import Counter

        import pyarrow as pa
        find, counts = re.compile(f"[{LETTERS}]{{{min_length},}}").findall, Counter()

        def flush():
            own = [w for w in counts if len(w) >= min_length]
            out = pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array([counts[w] for w in own], pa.int64())], names=["word", "n"])
            counts.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                runs = find((text.as_py() or "").encode().translate(ASCII_LOWER).decode())
                if rewrite is None:
                    counts.update(runs)
                else:
                    for word, n in Counter(runs).items():
                        counts[rewrite(key, word)] += n
                if len(counts) > COUNTED:
                    yield flush()
        yield flush()

    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def misspelt(key, run: str) -> str:
    """The run, less one letter where 97 divides the crc32 of ``<key>:<run>``."""
    import zlib
    h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
    if h % 97:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _halves(holes: DataFrame) -> DataFrame:
    """Each row (s, lo, hi, word, n) once for either half of its hole, with the key of that."""
    middle = "lo + (hi - lo) div 2"
    both = holes.select("word", "n", "s", F.expr(f"inline(array(struct(lo AS lo, cast({middle} AS int) AS hi), struct(cast({middle} AS int) AS lo, hi AS hi)))"))
    return both.where("lo < hi").withColumn("key", F.expr("concat_ws('|', s, lo, hi, left(word, lo), right(word, s - hi))"))


def lookup(words: list[str], s: int, lo: int, hi: int) -> list[int]:
    """For each of the words of one hole, the bitset (bit k: ``words[k]``) of those near it whose common prefix ends in the hole."""
    width = hi - lo
    slices: list[dict[str, int]] = [{} for _ in range(width + 1)]
    short = longer = 0
    inner = []
    for k, word in enumerate(words):
        bit = 1 << k
        if len(word) == s:
            short |= bit
            inner.append(word[lo:hi])
        else:
            longer |= bit
            inner.append(word[lo:hi + 1])
        for at, letter in zip(slices, inner[-1]):
            at[letter] = at.get(letter, 0) | bit
    found = []
    last = hi == s
    for own in inner:
        if len(own) == width:
            # agreeing so far; one letter replaced so far; one letter of theirs inserted so far
            agree, replaced, inserted = short | longer, 0, longer
            for i, letter in enumerate(own):
                here = slices[i].get(letter, 0)
                on = agree & here
                replaced = replaced & here | agree ^ on
                inserted = inserted & slices[i + 1].get(letter, 0) | on
                agree = on
            inserted &= longer
            found.append(replaced & short | (inserted if last else inserted & ~agree))
        else:
            agree, deleted = short, 0
            for i, letter in enumerate(own):
                deleted = (deleted & slices[i - 1].get(letter, 0) if i else 0) | agree
                if i < width:
                    agree &= slices[i].get(letter, 0)
            found.append(deleted if last else deleted & ~agree)
    return found


def _near(batches: Iterator) -> Iterator:
    """Rows sorted by key and falling count -> (word, n_near, best): what each word finds in each of its holes."""
    import pyarrow as pa

    def results(hole):
        (s, lo, hi), words, counts = hole
        for word, bits in zip(words, lookup(words, s, lo, hi)):
            if bits:
                best = (bits & -bits).bit_length() - 1
                yield word, bits.bit_count(), counts[best], words[best]

    def table(rows):
        columns = list(zip(*rows)) or [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
                                          names=["word", "n_near", "best_n", "best"])

    key, hole, out = None, None, []
    for batch in batches:
        for k, s, lo, hi, word, n in zip(*(c.to_pylist() for c in batch.columns)):
            if k != key:
                if hole:
                    out += results(hole)
                    if len(out) > 20_000:
                        yield table(out)
                        out = []
                key, hole = k, ((s, lo, hi), [], [])
            hole[1].append(word)
            hole[2].append(n)
    if hole:
        out += results(hole)
    yield table(out)


def near_words(vocab: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(word, n_near, best_n, best) for each hole in which a word of ``vocab`` (word, n) has near words."""
    spark, found = vocab.sparkSession, None
    size = F.length("word")
    holes = vocab.select("word", "n", F.explode(F.array(size, size - 1)).alias("s")).withColumn("lo", F.lit(0)).withColumn("hi", F.col("s"))
    while True:
        rows = stored(_halves(holes), "spelling-holes")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("words"), (F.max("hi") - F.max("lo")).alias("width")).where("words > 1")
        sizes = stored(sizes.select("key", (F.col("words") > limit).__and__(F.col("width") > 1).alias("again")), "spelling-sizes")
        ready = rows.join(sizes.where("not again").select("key"), "key", "left_semi")
        part = ready.select("key", "s", "lo", "hi", "word", "n").repartition("key").sortWithinPartitions("key", F.desc("n"), "word").mapInArrow(
            _near, "word string, n_near long, best_n long, best string")
        part = stored(part, "spelling-near")
        found = part if found is None else found.unionByName(part)
        large = sizes.where("again").select("key")
        if large.isEmpty():
            return found
        holes = rows.join(large, "key", "left_semi").drop("key")


def variants(vocab: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each word of ``vocab`` (word, n).

    The form of a word is its most frequent near word (of equal ones the first in code-point order) if that
    has at least twice its count; the root is where following forms ends."""
    vocab = stored(vocab.select("word", "n"), "spelling-words")
    near = near_words(vocab, limit).select("word", F.lit(None).cast("long").alias("n"), "n_near", F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("word")).alias("best"))
    none = F.lit(None).cast(near.schema["best"].dataType)
    rows = vocab.select("word", "n", F.lit(0).cast("long").alias("n_near"), none.alias("best")).unionByName(near).groupBy("word").agg(
        F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    taken = F.col("n") * 2 <= -F.col("best.n")
    rows = stored(rows.select("word", "n", "n_near", F.when(taken, F.col("best.word")).alias("form"), F.when(taken, -F.col("best.n")).alias("form_n")), "spelling-forms")
    # Counts double at each step, so paths are short; each round doubles how far a word has followed its own.
    paths = stored(rows.where("form is not null").select("word", F.col("form").alias("root")), "spelling-paths")
    while True:
        further = paths.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stored(paths.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-paths")
        paths = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            break
    return rows.join(paths, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

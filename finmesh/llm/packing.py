"""Sum-of-squares packing of documents into sequences (operator 9).

A document's ids (and a closing id) are cut into pieces only where they exceed a
sequence.  Every piece is put where the sum over gaps of (open sequences with that
gap) squared becomes smallest: the number of open sequences stays spread over many
gaps, so that what comes later finds an exact place.

Pieces are dealt to packers by hash, each of a bounded number of pieces; a packer takes
them by falling length.  Sequences it fills to within ``slack`` are done; pieces of the
others go to the next round, which has as many fewer packers, until one packer holds
the rest.  Only lengths and keys are shuffled, never text or ids.

Tokenizing keeps a bounded dictionary of white-space chunks per task: such chunks are
tokenized apart from each other by the tokenizer's own rules, so each is sent to it once.

Null texts count as empty (one closing id).  Repeated ids make repeated pieces, each
placed on its own.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmesh.llm.bpe import _Known, _room
from finmesh.llm.common import stored

MAX_CHUNKS = 600_000     # dictionary size of a task at which it starts anew
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
# White space of the tokenizer's own pattern; str.split() also splits at \x1c-\x1f.
CHUNK = "[^\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
APART = "\x00"           # between parts that are tokenized together: one id, of its own
PUNCTUATION = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"      # ASCII, without the apostrophe of contractions


def chunks_of(text: str, specials: tuple = (), folds: bool = True) -> list[str]:
    """White-space chunks, lower-cased where that provably changes no id: ``folds`` says that the tokenizer lower-cases.
    A text with the string of one of the ``specials``, in any case, stays whole."""
    import re
    import unicodedata
    if specials and (low := text.lower()) and any(s in low for s in specials):
        return [text]
    if folds and unicodedata.is_normalized("NFC", text) and "Σ" not in text:
        lower = text.lower()
        if unicodedata.is_normalized("NFC", lower):
            text = lower
    if any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return re.findall(CHUNK, text)
    return text.split()


def rules_of(tokenizer) -> tuple[tuple, bool]:
    """(lower-cased strings of the special tokens, whether the normaliser lower-cases).  A special token's string in a
    text is that token, as the library has it by default."""
    import json
    specials = tuple(t.content.lower() for t in tokenizer.get_added_tokens_decoder().values())
    return specials, '"Lowercase"' in json.dumps(json.loads(tokenizer.to_str())["normalizer"])


def load_tokenizer(content: str):
    """One tokenizer for all tasks of a Python worker: loading it anew leaves memory behind each time."""
    import hashlib

    import tokenizers
    loaded = vars(tokenizers).setdefault("_loaded", {})
    key = hashlib.sha256(content.encode()).digest()
    if key not in loaded:
        loaded[key] = tokenizers.Tokenizer.from_str(content)
    return loaded[key]


def parts_of(chunk: str) -> tuple[str, str]:
    """A chunk and the punctuation that ends it, where the tokenizer's pattern cuts between the two.  A whole text stays whole."""
    if chunk.split() != [chunk] or "<" in chunk:
        return chunk, ""
    stem = chunk.rstrip(PUNCTUATION)
    # İ is the letter whose lower case ends with a mark, which goes with the signs after it
    return (stem, chunk[len(stem):]) if stem and stem[-1].isalnum() and stem[-1] != "İ" else (chunk, "")


def encode_parts(tokenizer, parts: list[str]):
    """(ids of all parts one after another, number of ids of each)."""
    import numpy as np
    if any(APART in p for p in parts):
        own = [np.array(tokenizer.encode(p, add_special_tokens=False).ids, np.int64) for p in parts]
        return np.concatenate(own), np.array([len(x) for x in own])
    mark, = tokenizer.encode(APART, add_special_tokens=False).ids
    ids = np.array(tokenizer.encode_batch_fast([f" {APART} ".join(["", *parts, ""])], add_special_tokens=False)[0].ids)
    at = np.flatnonzero(ids == mark)
    return np.delete(ids, at), np.diff(at) - 1


def pieces(df: DataFrame, tokenizer_json: str, size: int = 2048, closing_id: int = 0,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document.  ``tokenizer_json``: the file's content."""
    def run(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        tokenizer = load_tokenizer(tokenizer_json)
        specials, folds = rules_of(tokenizer)
        empty = lambda: (_Known(), _Known(), np.zeros((1 << 12, 2), np.int64), np.empty(1 << 16, np.int32), np.zeros(1 << 12, np.int64), 0)
        chunks, parts, parts_at, flat, ends, n_flat = empty()
        steps, closing = np.arange(1 << 15), np.uint32(closing_id).astype("<u4").tobytes()
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                if len(chunks) > MAX_CHUNKS:
                    chunks, parts, parts_at, flat, ends, n_flat = empty()
                before, places = len(chunks), []
                for text in part.column(1):
                    found = chunks_of(text.as_py(), specials, folds)
                    places.append(np.fromiter(map(chunks.__getitem__, found), dtype=np.int64, count=len(found)))
                if chunks.added:
                    n_parts = len(parts)
                    pairs = np.array([(parts[a], parts[b]) for a, b in map(parts_of, chunks.added)], np.int64)
                    parts_at = _room(parts_at, before, len(pairs))
                    parts_at[before:before + len(pairs)] = pairs
                    chunks.added.clear()
                if parts.added:
                    ids, lens = encode_parts(tokenizer, parts.added)
                    flat, ends = _room(flat, n_flat, len(ids)), _room(ends, n_parts + 1, len(lens))
                    flat[n_flat:n_flat + len(ids)] = ids
                    ends[n_parts + 1:n_parts + 1 + len(lens)] = n_flat + np.cumsum(lens)
                    n_flat += len(ids)
                    parts.added.clear()
                rows = []
                for doc_id, own in zip(part.column(0).to_pylist(), places):
                    own = parts_at[own].ravel()
                    starts = ends[own]
                    lens = ends[own + 1] - starts
                    stops = np.cumsum(lens)
                    n = int(stops[-1]) if len(stops) else 0
                    at = np.repeat(starts - stops + lens, lens)
                    at += steps[:n] if n <= len(steps) else np.arange(n)
                    ids = flat[at].astype("<u4", copy=False)
                    for k, at in enumerate(range(0, n + 1, size)):          # the closing id is the last
                        crc = zlib.crc32(ids[at:at + size])
                        rows.append((doc_id, k, at, size, crc) if at + size <= n else (doc_id, k, at, n + 1 - at, zlib.crc32(closing, crc)))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                    zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(run, PIECES)


def sum_of_squares(lengths, size: int):
    """(sequence, offset) of each length, in the order given, and the fill of each sequence."""
    import numpy as np
    n_open = np.zeros(size + 1, dtype=np.int64)         # by gap; n_open[size] stands for a new sequence
    by_gap: list[list[int]] = [[] for _ in range(size + 1)]
    fill: list[int] = []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    blocked = np.iinfo(np.int64).max
    for i, s in enumerate(lengths):
        change = np.where(n_open[s:] > 0, -2 * n_open[s:] + 2 * n_open[:size + 1 - s] + 2, blocked)
        if n_open[s] > 0:
            change[0] = -2 * n_open[s] + 1              # filled to the end: no gap is left
        change[size - s] = 2 * n_open[size - s] + 1 if s < size else 0
        gap = s + int(np.argmin(change))                # ties: the smallest gap
        if gap == size:
            at = len(fill)
            fill.append(0)
        else:
            at = by_gap[gap].pop()
            n_open[gap] -= 1
        where[i], offset[i] = at, fill[at]
        fill[at] += s
        if gap > s:
            by_gap[gap - s].append(at)
            n_open[gap - s] += 1
    return where, offset, np.array(fill, np.int64)


def pack(parts: DataFrame, size: int = 2048, pieces_per_packer: int = 40_000, slack: int = 16) -> DataFrame:
    """Rows of ``pieces`` with sequence_id and offset."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    parts = stored(parts.select(*columns), "pack-pieces")
    full = parts.where(F.col("length") == size).select(
        *columns, F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    done, rest, round_no, before = [full], parts.where(F.col("length") < size), 1, None
    while True:
        n = rest.count()
        if not n:
            break
        packers = -(-n // pieces_per_packer)
        last = packers == 1 or before is not None and n > 0.7 * before     # rounds end where they no longer help
        packed = stored(rest.withColumn("packer", F.pmod(F.xxhash64("doc_id", "piece", F.lit(round_no)), F.lit(packers)))
                        .groupBy("packer").applyInPandas(_packer(size, -1 if last else slack, round_no), PIECES + ", sequence_id long, offset long"),
                        f"pack-round{round_no}")
        done.append(packed.where("sequence_id is not null"))
        if last:
            break
        rest, before, round_no = packed.where("sequence_id is null").select(*columns), n, round_no + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _packer(size: int, slack: int, round_no: int):
    """slack -1: every sequence is done."""
    def run(key, rows):
        rows = rows.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        where, offset, fill = sum_of_squares(rows["length"].to_numpy(), size)
        done = slack < 0 or fill[where] >= size - slack
        rows["sequence_id"] = ((round_no << 52) + (int(key[0]) << 20) + where).astype("int64")
        rows["offset"] = offset
        rows["sequence_id"] = rows["sequence_id"].astype("Int64")
        if slack >= 0:
            rows.loc[~done, "sequence_id"] = None
        return rows.drop(columns="packer")
    return run

"""Secret scan with a password guess-cost dynamic programme (operator 10).

Base spans come from three fixed patterns (assign, access, hex).  The method adds spans of
kind ``guess``: the value in a credential context ("pwd: ...", "Kennwort = ...") is cut
into words, dates, repeats, keyboard walks and brute-force runs so that the number of
guesses an attacker needs is smallest; a value that still needs ``MIN_BITS`` bits is a
secret; the whole value is judged, and what base spans leave of it is added.  Words cost the logarithm of their rank in the corpus: ranks are counted over all
documents, and those of all words that are part of a value are used, however rare.

Nulls count as empty; spans are in code points, end exclusive; repeated rows are judged
each on its own.
"""
from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmesh.llm.common import hex_sha256, stored

KINDS = ("assign", "access", "hex", "guess")
DICTIONARY = 20_000      # most frequent words that are known beside those of the values
COUNTED = 400_000        # distinct words and parts of values a task holds before it hands on its partial counts
MIN_BITS = 40.0
MIN_VALUE = 8            # characters of a credential value

# The base patterns.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"
# Words that announce a credential, in the languages of the corpus.
CONTEXT = ("password", "passwd", "passphrase", "passcode", "pwd", "passwort", "kennwort", "contraseña", "contrasena", "clave",
           "mot de passe", "mdp", "secret", "token", "api key", "api_key", "apikey", "access key", "access_key", "private key",
           "private_key", "client_secret", "credential", "auth", "bearer", "login")
HINTS = ("passw", "passp", "passc", "pwd", "kennwort", "contrase", "clave", "mot de passe", "mdp", "secret", "token", "api", "key",
         "credential", "auth", "bearer", "login")
# Of these, words that prose too puts before a colon: a value of one kind of character after them is no credential.
PROSE = ("secret", "token", "credential", "auth", "bearer", "login", "clave")
# Words that are guessed first, whatever the corpus has.
COMMON = ("password", "admin", "welcome", "letmein", "login", "dragon", "monkey", "master", "secret", "iloveyou", "sunshine",
          "princess", "football", "baseball", "shadow", "superman", "hello", "freedom", "whatever", "trustno", "changeme", "test",
          "guest", "root", "user", "default", "pass", "example", "sample", "your", "token", "none", "null", "true", "false")
KEYBOARD = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
DATES = (r"(?:19|20)\d\d[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:0?[1-9]|[12]\d|3[01])", r"(?:0?[1-9]|[12]\d|3[01])[-/._]?(?:0?[1-9]|1[0-2])[-/._]?(?:19|20)\d\d",
         r"(?:19|20)\d\d")
LEET = str.maketrans("@4301!5$7", "aaeoiisst")
LONGEST = 32             # characters of a word, repeat or walk; longer ones are several
SEGMENT_BITS = 1.0       # each segment doubles what an attacker tries


def word_ranks(df: DataFrame, text_col: str = "text") -> dict[str, int]:
    """Ranks of all words that the values in ``df`` may hold, and of the most frequent ones.

    A word's rank is the number of words more frequent than it and half of those as frequent, in all documents.
    Values themselves do not count: a secret in many copies is no word.  What comes to the driver is the words
    that are part of a value, DICTIONARY more, and how many words there are of each count."""
    def run(batches: Iterator) -> Iterator:
        import re
        from collections import Counter

        import pyarrow as pa
        signs = re.compile("[\u00a0-\u00bf\u2010-\u205e]+")      # quotes, dashes and the like beyond ASCII
        letters = bytes(b if chr(b).isalpha() or b > 127 else 32 for b in range(256))
        patterns, counts, asked = compiled(), Counter(), set()

        def flush():
            own = [w for w in counts if 3 <= len(w) <= LONGEST]
            words = [w.decode("utf-8", "ignore") for w in own] + list(asked)
            table = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array([counts[w] for w in own] + [0] * len(asked), pa.int64()),
                                                pa.array([False] * len(own) + [True] * len(asked), pa.bool_())], names=["word", "n", "asked"])
            counts.clear()
            asked.clear()
            return table

        for batch in batches:
            for text in batch.column(0).to_pylist():
                parts, at = [], 0
                for _, start, end in context_values(text, patterns):
                    parts.append(text[at:start])
                    at = end
                    asked.update(_substrings(text[start:end]))
                rest = " ".join([*parts, text[at:]]).lower()
                counts.update((rest if rest.isascii() else signs.sub(" ", rest)).encode().translate(letters).split())
                if len(counts) + len(asked) > COUNTED:
                    yield flush()
        yield flush()

    counts = stored(df.select(F.col(text_col).alias("text")).where("text is not null").mapInArrow(run, "word string, n long, asked boolean").groupBy("word").agg(
        F.sum("n").alias("n"), F.max("asked").alias("asked")).where("n > 0"), "word-counts")
    above, middle = len(COMMON), {}
    for n, words in sorted(counts.groupBy("n").count().collect(), reverse=True):
        middle[n] = above + (words + 1) // 2
        above += words
    ranks = {w: i + 1 for i, w in enumerate(COMMON)}
    for frame in (counts.orderBy(F.desc("n"), "word").limit(DICTIONARY), counts.where("asked")):
        for row in frame.select("word", "n").collect():
            ranks.setdefault(row.word, middle[row.n])
    return ranks


def _substrings(value: str) -> set[str]:
    """The parts of a value that may be words, as they are and with look-alike signs read as letters."""
    if len(value) < MIN_VALUE or len(value) > LONGEST * MIN_BITS / SEGMENT_BITS:      # each segment costs that at least, so a longer one is a secret
        return set()
    lower = value.lower()
    found = set()
    for spelt in {lower, lower.translate(LEET)}:
        for i in range(len(spelt)):
            for j in range(i, min(len(spelt), i + LONGEST)):
                if spelt[j].isascii() and not spelt[j].isalpha():
                    break
                if j - i >= 2:
                    found.add(spelt[i:j + 1])
    return found


def guess_bits(value: str, ranks: dict[str, int], enough: float = math.inf) -> float:
    """log2 of the guesses that the cheapest segmentation of ``value`` needs; a lower bound of it once that reaches ``enough``."""
    import re
    lower = value.lower()
    if len(lower) != len(value):
        lower = value
    plain = lower.translate(LEET)
    dates: dict[int, list[int]] = {}
    for pattern in DATES:
        for i in range(len(value)):
            if value[i].isdigit() and (m := re.compile(pattern).match(value, i)):
                dates.setdefault(m.end(), []).append(i)
    # best[i]: bits of the first i characters, [0] ended by a segment, [1] within a brute-force run
    best = [(0.0, math.inf)] + [(math.inf, math.inf)] * len(value)
    for i in range(1, len(value) + 1):
        run = min(best[i - 1][1], min(best[i - 1]) + SEGMENT_BITS) + _char_bits(value[i - 1])
        whole = math.inf
        for j in range(max(0, i - LONGEST), i - 1):
            if i - j >= 3:
                cost = _word_bits(value, lower, plain, j, i, ranks)
                if _is_repeat(lower, j, i):
                    cost = min(cost, _char_bits(value[j]) + math.log2(i - j))
                if _is_walk(lower, j, i):
                    cost = min(cost, math.log2(94 * 2 * (i - j)))
                whole = min(whole, min(best[j]) + cost + SEGMENT_BITS)
        for j in dates.get(i, ()):
            whole = min(whole, min(best[j]) + (math.log2(120) if i - j == 4 else math.log2(365 * 120 * 6)) + SEGMENT_BITS)
        best[i] = (whole, run)
        # no segment but a brute-force run is longer than LONGEST, so every segmentation passes one of the last positions
        if i % LONGEST == 0 and (least := min(map(min, best[max(0, i - LONGEST):i + 1]))) >= enough:
            return least
    return min(best[-1])


def _char_bits(c: str) -> float:
    return math.log2(10 if c.isdigit() else 26 if c.isalpha() and c.isascii() else 33 if c.isascii() else 100)


def _word_bits(value: str, lower: str, plain: str, j: int, i: int, ranks: dict[str, int]) -> float:
    rank, extra = ranks.get(lower[j:i]), 0.0
    if rank is None:
        rank, extra = ranks.get(plain[j:i]), 2.0           # spelt with look-alike signs
    if rank is None:
        return math.inf
    upper = sum(c.isupper() for c in value[j:i])
    if upper:
        extra += 1.0 if upper == i - j or value[j].isupper() and upper == 1 else math.log2(math.comb(i - j, upper) + 1)
    return math.log2(rank + 1) + extra


def _is_repeat(s: str, j: int, i: int) -> bool:
    return s[j] * (i - j) == s[j:i]


def _is_walk(s: str, j: int, i: int) -> bool:
    part = s[j:i]
    steps = {ord(b) - ord(a) for a, b in zip(part, part[1:])}
    return steps in ({1}, {-1}) or any(part in row or part[::-1] in row for row in KEYBOARD)


def scan(text: str, ranks: dict[str, int], patterns: dict) -> tuple[list, list]:
    """(base spans, added spans) of one text, each (kind, start, end)."""
    base, added = [], []
    low = text.lower()
    hinted = any(h in low for h in HINTS)
    if hinted:
        base += [("assign", m.start(), m.end()) for m in patterns["assign"].finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        base += [("access", m.start(), m.end()) for m in patterns["access"].finditer(text) if len(m[0]) >= 16]
    base += [("hex", m.start(), m.end()) for m in patterns["hex"].finditer(text)]
    covered, at = _united(base), 0
    for word, start, end in context_values(text, patterns) if hinted else ():      # in order of start, none overlaps the next
        value = text[start:end]
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        if len(value) < MIN_VALUE or not (rest := _outside(start, end, covered, at)):
            continue
        # plain prose after "login:" is no credential: two kinds of character, not only a capital in front
        kinds = sum((any(c.isdigit() for c in value), any(c.islower() for c in value), any(c.isupper() for c in value[1:]),
                     any(not c.isalnum() for c in value)))
        if (kinds >= 2 or not word.lower().startswith(PROSE)) and guess_bits(value, ranks, MIN_BITS) >= MIN_BITS:
            added += [("guess", s, e) for s, e in rest]
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(base, key=lambda s: (s[1], order[s[0]])), added


def context_values(text: str, patterns: dict) -> Iterator[tuple[str, int, int]]:
    """(announcing word, start, end) of each value in a credential context."""
    low, at = text.lower(), 0
    if not any(h in low for h in HINTS):
        return
    while m := patterns["context"].search(text, at):
        start, end = m.span(2)
        end = start + len(text[start:end].rstrip(".,;:!?)]}"))
        at = max(m.end(1), end)
        yield m[1], start, end


def _united(spans: list[tuple]) -> list[tuple[int, int]]:
    """What (kind, start, end) spans cover, as disjoint stretches in order."""
    out: list[tuple[int, int]] = []
    for _, s, e in sorted(spans, key=lambda s: s[1]):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _outside(start: int, end: int, covered: list[tuple[int, int]], at: int) -> list[tuple[int, int]]:
    """The parts of a value that no stretch of ``covered`` covers; those before ``at`` end before the value."""
    parts = []
    while at < len(covered) and covered[at][0] < end:
        s, e = covered[at]
        if s > start:
            parts.append((start, s))
        start, at = max(start, e), at + 1
    return parts + [(start, end)] if start < end else parts


def compiled() -> dict:
    import re
    words = "|".join(sorted((re.escape(w).replace(r"\ ", "[ _-]?") for w in CONTEXT), key=len, reverse=True))
    return {"assign": re.compile(ASSIGN, re.I | re.A), "access": re.compile(ACCESS), "hex": re.compile(HEX),
            "context": re.compile(rf"""(?<![^\W_])((?:{words})s?)["']?[ \t]{{0,4}}(?::=|=>|->|[:=])[ \t]{{0,4}}["'`]?([^\s"'`<>]+)""", re.I)}


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def spans_of(df: DataFrame, ranks: dict[str, int] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_assign, n_access, n_hex, base_sha256, spans) of each document."""
    ranks = word_ranks(df, text_col) if ranks is None else ranks

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        patterns, order = compiled(), {k: i for i, k in enumerate(KINDS)}
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                base, added = scan(text, ranks, patterns)
                counts = [sum(s[0] == k for s in base) for k in KINDS[:3]]
                rows.append((*counts, hex_sha256(joined(base).encode()), joined(sorted(base + added, key=lambda s: (s[1], order[s[0]])))))
            columns = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), *(pa.array(c, pa.string()) for c in columns[3:])],
                                             names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def redact(df: DataFrame, text_col: str = "text", mark: str = "[SECRET]", ranks: dict[str, int] | None = None) -> DataFrame:
    """``df`` with every secret of its texts (overlapping spans as one) replaced by ``mark``."""
    ranks = word_ranks(df, text_col) if ranks is None else ranks
    place = df.columns.index(text_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        patterns = compiled()
        for batch in batches:
            texts = []
            for text in batch.column(place).to_pylist():
                base, added = scan(text, ranks, patterns) if text else ([], [])
                parts, at = [], 0
                for kind, start, end in sorted(base + added, key=lambda s: s[1]):
                    if start > at or start == at and not (parts and kind == "guess"):      # the rest of a value is one with its base span
                        parts += [text[at:start], mark]
                    at = max(at, end)
                texts.append("".join([*parts, text[at:]]) if parts else text)
            yield batch.set_column(place, batch.schema.field(place), pa.array(texts, pa.string()))

    return df.mapInArrow(run, df.schema)

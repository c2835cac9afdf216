"""Quality rules as a short-circuit cascade (operator 6).

Each rule rejects a document by one statistic of its text.  On a sample of the documents
every rule's cost (seconds a document) and selectivity (share rejected) is measured;
rules then run in falling order of rejections per cost, and a document stops at the first
that rejects it.  The order never changes which documents are kept.

Words are runs without ASCII white space.  Nulls have no words and fail ``few_words``.
Repeated rows are judged each on its own.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmesh.llm.common import UPPER, LOWER, fresh

SYMBOLS = b"#*$%&|<>"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SAMPLE_ROWS = 2000       # rows on which costs and selectivities are measured, about


class Text:
    """A document's statistics, each computed when first asked for."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def raw(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()          # bytes split at ASCII white space only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(map(self.text.count, " \t\n\x0b\x0c\r"))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x and not x.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words covered by a 3-word window that occurs twice or more."""
        import numpy as np
        if self.n_words < 4:
            return 0
        ids: dict[bytes, int] = {}
        at = np.array([ids.setdefault(w, len(ids)) for w in self.words], dtype=np.int64)
        pair = at[:-1] * len(ids) + at[1:]
        _, pair = np.unique(pair, return_inverse=True)         # below n_words, so the next product fits too
        window = pair[:-1] * len(ids) + at[2:]
        _, which, counts = np.unique(window, return_inverse=True, return_counts=True)
        twice = counts[which] > 1
        covered = np.zeros(self.n_words, dtype=bool)
        for k in range(3):
            covered[k:k + len(twice)] |= twice
        return int(covered.sum())

    @cached_property
    def n_upper(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, UPPER.encode()))

    @cached_property
    def n_lower(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, LOWER.encode()))


#: name -> does it reject?  The first two are the base rules.
RULES = {
    "few_words": lambda t: t.n_words < 50,
    "repeated_windows": lambda t: 100 * t.n_repeat_words > 50 * t.n_words,
    "symbols": lambda t: 100 * t.n_symbols > 25 * t.n_words,
    "upper_case": lambda t: t.n_upper > t.n_lower and t.n_upper > 20,
    "duplicate_lines": lambda t: 100 * t.n_dup_lines > 50 * len(t.lines),
    "word_length": lambda t: not 2 * t.n_words <= t.word_chars <= 20 * t.n_words,
}
BASE = ("few_words", "repeated_windows")


def measure(df: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS, rules=None) -> DataFrame:
    """(rule, cost, selectivity, score) on a sample of ``df``; as many rows as rules."""
    rules = rules or RULES
    n = df.count()

    def run(batches: Iterator) -> Iterator:
        import time

        import pyarrow as pa
        spent, rejected, seen = dict.fromkeys(rules, 0.0), dict.fromkeys(rules, 0), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen += 1
                for name, rejects in rules.items():
                    fresh_text, began = Text(text), time.perf_counter()
                    rejected[name] += rejects(fresh_text)
                    spent[name] += time.perf_counter() - began
        yield pa.RecordBatch.from_arrays([pa.array(list(rules)), pa.array(list(spent.values())), pa.array(list(rejected.values()), pa.int64()),
                                          pa.array([seen] * len(rules), pa.int64())], names=["rule", "spent", "rejected", "seen"])

    sample = df.select(F.col(text_col).alias("text")).sample(fraction=min(1.0, sample_rows / max(n, 1)), seed=7)
    total = sample.mapInArrow(run, "rule string, spent double, rejected long, seen long").groupBy("rule").agg(
        F.sum("spent").alias("spent"), F.sum("rejected").alias("rejected"), F.sum("seen").alias("seen"))
    return total.select("rule", (F.col("spent") / F.greatest("seen", F.lit(1))).alias("cost"),
                        (F.col("rejected") / F.greatest("seen", F.lit(1))).alias("selectivity"),
                        (F.col("rejected") / F.greatest("spent", F.lit(1e-9))).alias("score"))


def cascade_order(df: DataFrame, text_col: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Rule names by falling rejections per second; rules the sample does not know go last."""
    found = {r.rule: (-r.score, r.cost) for r in measure(df, text_col, sample_rows).collect()}
    return sorted(RULES, key=lambda name: found.get(name, (0.0, 0.0)))


def judge(df: DataFrame, order: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the five statistics, base_failed, kept) of each document."""
    rules = [RULES[name] for name in order or cascade_order(df, text_col)]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            rows = []
            for text in map(Text, batch.column(1).to_pylist()):
                kept = not any(rejects(text) for rejects in rules)
                rows.append([getattr(text, f) for f in FEATURES] + [any(RULES[b](text) for b in BASE), kept])
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.bool_()) for c in columns[5:])],
                names=["doc_id", *FEATURES, "base_failed", "kept"])

    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, " + ", ".join(f"{f} long" for f in FEATURES) + ", base_failed boolean, kept boolean")


def keep(df: DataFrame, order: list[str] | None = None, text_col: str = "text") -> DataFrame:
    """The rows of ``df`` that no rule rejects; only the statistics the cascade asks for are computed."""
    rules = [RULES[name] for name in order or cascade_order(df, text_col)]
    # the text goes to the worker once if it is a column as it stands
    own = df if text_col in df.columns else df.select("*", F.col(text_col).alias(fresh(df, "judged_text")))
    at, n_columns = own.columns.index(text_col) if own is df else len(df.columns), len(df.columns)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for batch in batches:
            # a text is a string in Python only while it is judged
            good = [not any(rejects(t) for rejects in rules) for t in (Text(x.as_py()) for x in batch.column(at))]
            yield batch.select(range(n_columns)).filter(pa.array(good, pa.bool_()))

    return own.mapInArrow(run, df.schema)

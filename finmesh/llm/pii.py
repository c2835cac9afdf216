"""Personal data by weak supervision (operator 3).

Base spans (email, ip, card, phone) come from fixed patterns.  The method adds spans of
further kinds.  Wide patterns propose candidates, base spans among them; labelers (regular
expression, gazetteer, context words, checksum, shape) vote yes, no or nothing on each.
Expectation-maximisation over the counts of vote patterns of all candidates estimates each
labeler's reliability without labels; its posteriors train a logistic span classifier on a
bounded sample, and the classifier decides on every candidate that is not a base span.

Only vote-pattern counts (kinds times 3 to the labelers, at most) and ``TRAIN_SPANS`` sample
rows reach the driver.  Nulls count as empty; spans are in code points, end exclusive.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from finmesh.llm.common import hex_sha256, stored

BASE = ("email", "ip", "card", "phone")
EXTRA = ("name", "address", "iban", "ssn", "local_phone", "spelt_email", "ipv6", "long_number")
KINDS = BASE + EXTRA
LABELERS = ("regex", "gazetteer", "context", "checksum", "shape")
TRAIN_SPANS = 20_000         # rows of the classifier's sample, the first by hash
THRESHOLD = 0.9
WINDOW = 48                  # characters of context on the left
SPAN = "struct<kind:string,start:int,end:int,votes:array<tinyint>,features:array<float>>"

# The base patterns (the email pattern's part from the @ on).
EMAIL_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL_REST = r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

PROPOSE = {
    "name": r"\b(?:Mr|Mrs|Ms|Miss|Dr|Prof|Herr|Frau|Mme|Mlle|Sra|Sr|Don|Doña)\.? [A-ZÀ-Þ][a-zß-ÿ]+(?: [A-ZÀ-Þ][a-zß-ÿ]+){0,2}",
    "address": r"\b\d{1,5} [A-ZÀ-Þ][a-zß-ÿ]+(?: [A-ZÀ-Þ][a-zß-ÿ]+)? (?:Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Drive|Dr|Boulevard|Blvd)\b|\b[A-ZÀ-Þ][a-zß-ÿ]+(?:straße|strasse|weg|platz) \d{1,4}\b|\b(?:rue|avenue|calle|avenida) [A-ZÀ-Þa-zß-ÿ ]{3,30} \d{1,4}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "local_phone": r"(?<![\w+(.-])(?:\(\d{2,5}\) ?|0\d{1,4}[ /-])\d{3,4}[ -]?\d{2,5}(?![\w.-])",
    "spelt_email": r"\b[A-Za-z0-9._%+-]{2,40} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{2,40} ?(?:\(dot\)|\[dot\]| dot ) ?[a-z]{2,8}\b",
    "ipv6": r"(?<![\w:])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![\w:])",
    "long_number": r"(?<![\w.-])\d{9,15}(?![\w.-])",
}
# Small public gazetteers: given names, country codes of IBANs, towns.
GIVEN = frozenset("""James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica
Thomas Sarah Charles Karen Anna Peter Paul Maria Hans Klaus Ursula Wolfgang Sabine Monika Jürgen Stefan Andreas Christian Martin
Jean Pierre Marie Michel Philippe Nathalie Isabelle Jacques François Catherine José Antonio Manuel Francisco Carmen Ana Isabel
Juan Carlos Luis Jorge Pedro Miguel Elena Laura Emma Sofia Lucas""".split())
IBAN_COUNTRIES = frozenset("DE FR ES GB AT CH NL BE IT PT IE LU PL SE DK NO FI CZ".split())
CONTEXT = {
    "email": ("mail", "contact", "write"), "ip": ("ip", "address", "host", "server", "login"), "card": ("card", "visa", "karte", "carte", "tarjeta", "pay"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "reach"), "name": ("name", "dear", "patient", "signed", "contact", "nom", "nombre"),
    "address": ("address", "live", "street", "adresse", "wohn", "direcci"), "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security", "number"), "local_phone": ("phone", "call", "tel", "mobile", "fax", "handy"),
    "spelt_email": ("mail", "contact", "write"), "ipv6": ("ip", "address", "host"), "long_number": ("account", "passport", "id", "customer", "konto", "compte"),
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_ok(s: str) -> bool:
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def compiled() -> dict:
    import re
    own = {"email": EMAIL_REST, "ip": IP, "card": CARD, "phone": PHONE}
    return {k: re.compile(p, re.A) for k, p in own.items()} | {k: re.compile(p) for k, p in PROPOSE.items()} | {"digit": re.compile("[0-9]")}


def base_spans(text: str, patterns: dict) -> list[tuple[str, int, int]]:
    """By kind as listed, then start."""
    found = []
    at, last = text.find("@"), 0
    while at >= 0:
        start = at
        while start > last and text[start - 1] in EMAIL_LOCAL:
            start -= 1
        # the local part begins at the earliest character of its run that the last match left
        if start < at and (m := patterns["email"].match(text, at)):
            found.append(("email", start, m.end()))
            last = m.end()
        else:
            last = max(last, at + 1)
        at = text.find("@", last)
    if patterns["digit"].search(text):
        found += [("ip", m.start(), m.end()) for m in patterns["ip"].finditer(text)
                  if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split("."))]
        for m in patterns["card"].finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
        if "+" in text:
            found += [("phone", m.start(), m.end()) for m in patterns["phone"].finditer(text) if 8 <= sum(map(str.isdigit, m[0])) <= 15]
    return found


def votes_of(kind: str, text: str, start: int, end: int) -> list[int]:
    """Votes of the labelers in order: 1 yes, 0 no, -1 nothing."""
    value, left = text[start:end], text[max(0, start - WINDOW):start].lower()
    digits = "".join(c for c in value if c.isdigit())
    strict = {"name": value.count(" ") >= 2, "address": any(c.isdigit() for c in value), "local_phone": 9 <= len(digits) <= 12, "long_number": False}
    regex = int(strict.get(kind, True))
    gazetteer = -1
    if kind == "name":
        gazetteer = int(any(w in GIVEN for w in value.replace(".", " ").split()[1:]))
    elif kind == "iban":
        gazetteer = int(value[:2] in IBAN_COUNTRIES)
    elif kind == "email" or kind == "spelt_email":
        gazetteer = 1 if value.lower().endswith(("com", "org", "net", "de", "fr", "es", "uk")) else -1
    words = left.replace(":", " ").split()
    context = 1 if any(w.startswith(c) for w in words for c in CONTEXT[kind]) else -1
    checksum = -1
    if kind == "card":
        checksum = int(luhn(digits))
    elif kind == "iban":
        checksum = int(iban_ok(value))
    elif kind == "ssn":
        checksum = int(value[:3] not in ("000", "666") and value[0] != "9" and value[4:6] != "00" and value[7:] != "0000")
    elif kind == "ip":
        checksum = int(not value.startswith(("0.", "255.")))
    shape = -1
    if len(digits) >= 6:
        shape = int(len(set(digits)) > 2 and digits not in "01234567890123456789")
    elif kind in ("name", "spelt_email"):
        shape = int(len(value) <= 60)
    return [regex, gazetteer, context, checksum, shape]


def features_of(kind: str, text: str, start: int, end: int, votes: list[int]) -> list[float]:
    value = text[start:end]
    n = max(1, len(value))
    before, after = text[start - 1:start], text[end:end + 1]
    return ([float(kind == k) for k in KINDS] + [float(v == 1) for v in votes] + [float(v == 0) for v in votes]
            + [min(n, 60) / 60, sum(c.isdigit() for c in value) / n, sum(c.isupper() for c in value) / n, value.count(" ") / n,
               float(before in (" ", "\n", "", ":", "(", "<")), float(after in (" ", "\n", "", ".", ",", ")", ">"))])


def _merged(spans) -> list[tuple[int, int]]:
    """The stretches that spans cover, in order."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _apart(spans: list, taken: list) -> list[tuple[int, int]]:
    """Those of ``spans`` that touch nothing ``taken``; both in order, one walk."""
    out, at = [], 0
    for start, end in spans:
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if at == len(taken) or taken[at][0] >= end:
            out.append((start, end))
    return out


def _scan(batches: Iterator) -> Iterator:
    import pyarrow as pa
    patterns = compiled()
    kind_of = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("votes", pa.list_(pa.int8())), ("features", pa.list_(pa.float32()))])
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            spans = base_spans(text, patterns)
            taken = _merged((start, end) for _, start, end in spans)
            digits = bool(patterns["digit"].search(text))
            for kind in EXTRA:
                if not digits and kind not in ("name", "address", "spelt_email") or kind == "spelt_email" and "dot" not in text or kind == "ipv6" and ":" not in text:
                    continue
                own = _apart([m.span() for m in patterns[kind].finditer(text)], taken)
                if own:
                    spans += [(kind, start, end) for start, end in own]
                    taken = _merged(taken + own)
            out = []
            for kind, start, end in spans:
                votes = votes_of(kind, text, start, end)
                out.append({"kind": kind, "start": start, "end": end, "votes": votes, "features": features_of(kind, text, start, end, votes)})
            rows.append(out)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kind_of))], names=["doc_id", "spans"])


def reliabilities(counts: list[tuple[str, tuple, int]], rounds: int = 50) -> tuple[dict, dict]:
    """EM over (kind, votes, count): each labeler's chance of voting yes on true and on false
    candidates, and the posterior of every (kind, votes).  Kinds have their own share of truth."""
    import numpy as np
    if not counts:
        return {}, {}
    kinds = sorted({k for k, _, _ in counts})
    kind = np.array([kinds.index(k) for k, _, _ in counts])
    votes, n = np.array([v for _, v, _ in counts]), np.array([c for _, _, c in counts], float)
    said = votes >= 0
    # start: the share of yes among the votes given
    p = np.clip(np.where(said, votes, 0).sum(1) / np.maximum(said.sum(1), 1), 0.05, 0.95)
    for _ in range(rounds):
        prior = np.array([(n * p)[kind == k].sum() + 1 for k in range(len(kinds))]) / np.array([n[kind == k].sum() + 2 for k in range(len(kinds))])
        yes_true = ((n * p)[:, None] * (votes == 1)).sum(0) + 8
        of_true = ((n * p)[:, None] * said).sum(0) + 10
        yes_false = ((n * (1 - p))[:, None] * (votes == 1)).sum(0) + 2
        of_false = ((n * (1 - p))[:, None] * said).sum(0) + 10
        sens, fall = np.clip(yes_true / of_true, 0.01, 0.99), np.clip(yes_false / of_false, 0.01, 0.99)
        log_true = np.log(prior)[kind] + (said * np.where(votes == 1, np.log(sens), np.log(1 - sens))).sum(1)
        log_false = np.log(1 - prior)[kind] + (said * np.where(votes == 1, np.log(fall), np.log(1 - fall))).sum(1)
        p = 1 / (1 + np.exp(np.clip(log_false - log_true, -50, 50)))
    return ({name: (float(s), float(f)) for name, s, f in zip(LABELERS, sens, fall)},
            {(k, v): float(x) for (k, v, _), x in zip(counts, p)})


def train(features, targets, steps: int = 400, rate: float = 0.5, decay: float = 1e-3):
    """Logistic regression on soft targets by gradient descent; (weights, bias)."""
    import numpy as np
    x, y = np.asarray(features, float), np.asarray(targets, float)
    w, b = np.zeros(x.shape[1]), 0.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(x @ w + b))) - y
        w -= rate * (x.T @ error / len(y) + decay * w)
        b -= rate * error.mean()
    return w, b


def joined(spans) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def spans_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of each document."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    scanned = stored(docs.mapInArrow(_scan, f"doc_id long, spans array<{SPAN}>"), "pii-candidates")
    each = scanned.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.*")
    counts = [(r.kind, tuple(r.votes), r.n) for r in each.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", "votes").collect()]
    _, posterior = reliabilities(counts)
    sample = each.select("kind", "votes", "features", F.xxhash64("doc_id", "kind", "start").alias("h")).orderBy("h").limit(TRAIN_SPANS).collect()
    weights, bias = train([r.features for r in sample], [posterior[r.kind, tuple(r.votes)] for r in sample]) if sample else ([], 0.0)

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        for batch in batches:
            rows = []
            for spans in batch.column(1).to_pylist():
                base = [(s["kind"], s["start"], s["end"]) for s in spans if s["kind"] in BASE]
                added = [(s["kind"], s["start"], s["end"]) for s in spans if s["kind"] not in BASE
                         and 1 / (1 + np.exp(-(np.dot(s["features"], weights) + bias))) >= threshold]
                ordered = sorted(base + added, key=lambda s: (KINDS.index(s[0]), s[1]))
                rows.append((*(sum(b[0] == k for b in base) for k in BASE), hex_sha256(joined(base).encode()), joined(ordered)))
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:4]), *(pa.array(c, pa.string()) for c in columns[4:])],
                                             names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return scanned.mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")

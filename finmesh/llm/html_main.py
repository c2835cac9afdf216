"""Main text of a page by a maximum-scoring subsequence (operator 7).

A page is a sequence of words and tags.  Words score positive (negative inside menus,
adverts and the like), tags negative; one linear scan finds the contiguous run of highest
score.  The scores come from labelled pages: pages that mark their content with <article>
or <main> say which words and tags lie inside it, and a class (plain word, link word, word in a
boilerplate element, each tag name) scores by how often it does.

The run is widened to the <article> or <main> element around it or, without one, to the
innermost <div>, <section> or table cell that holds all of it.  Its text is written block by block: boilerplate elements inside it (menus, headers of the page,
footers, sidebars, notices, adverts, forms, scripts, styles, comments) are left out,
character references decoded, white space inside a block made one space, blocks joined by
one line feed.  <br> is white space.

Null or empty html, or html without words, gives the empty text.  Unclosed and crossing elements end where
their parent ends; what is cut off mid-tag is no text.
"""
from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRAIN_PAGES = 2000       # about so many labelled pages, by hash of the id, give the scores

BOILER_TAGS = frozenset("head nav footer aside form button select option label fieldset dialog menu noscript iframe object template svg canvas audio video".split())
RAW_TAGS = ("script", "style", "textarea", "title", "noscript", "template", "svg")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr img br td th".split())
LOOSE = frozenset("p li dt dd tr option b i em strong span font".split()) | INLINE      # often left open: never on the stack, but for links
STRONG = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb
breadcrumbs footer cookie cookies consent gdpr popup modal comment comments disqus respond reply replies social share sharing related
recommended newsletter subscribe signup pagination pager toolbar copyright masthead""".split())
WEAK = frozenset("header banner side notice alert search widget login legal tags skip links".split())
CONTENT = frozenset("article post entry content story main body text".split())
LAYOUT = frozenset("""ads advert adverts advertisement sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer
gdpr popup modal disqus newsletter subscribe signup pagination pager toolbar masthead""".split())      # words of STRONG that are seldom a text's subject
FURNITURE = frozenset("""box boxes bar list lists container wrapper wrap inner outer holder area block section panel pane column col row grid item items
button buttons btn icon icons post posts article articles story stories entry content main body site page global primary secondary fixed sticky mobile
desktop small large big mini top bottom left right center form input title heading count counter counts toggle open close closed overlay layer slot unit
zone thread save wide leaderboard skyscraper google logo info message text tools trail trigger""".split())      # what stands beside them in known compounds
NEGATED = frozenset("has no not with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
DEFAULT = {"plain": 1.0, "link": -0.5, "boiler": -3.0, "tag": -1.5}


def compiled():
    import re
    raw = "|".join(RAW_TAGS)
    attributes = r"(?:\"[^\"]*\"|'[^']*'|[^>\"'])*+"
    return {                                          # a self-closed svg is empty; of HTML's own elements the slash closes none
        "token": re.compile(rf"<!--.*?(?:-->|\Z)|<svg(?=[\s/]){attributes}(?<=/)>|<({raw})(?=[\s/>]){attributes}>.*?(?:</\1\s*>|\Z)"
                            r"|<(/?)([A-Za-z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*+)>|<[/!?A-Za-z][^>]*+(?:>|\Z)", re.S | re.I),
        "marks": re.compile(r"(?<![\w-])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I),
        "hidden": re.compile(r"\bhidden(?=[\s=/]|\Z)|display\s*:\s*none", re.I),
        "parts": re.compile(r"[A-Za-z][a-z]*|\d+"),
    }


def is_boiler(name: str, attributes: str, in_content: bool, patterns) -> bool:
    if name in BOILER_TAGS or name == "header" and not in_content:
        return True
    if name in ("html", "body", "article", "main") or not attributes:
        return False
    if patterns["hidden"].search(attributes):
        return True
    for m in patterns["marks"].finditer(attributes):
        value = m[1] or m[2] or m[3] or ""
        if m[0][:4].lower() == "role":
            if value.strip().lower() in ROLES:
                return True
        elif name not in HEADINGS or m[0][:2].lower() != "id":      # ids of headings are made from their text
            weak = not any(p.lower() in CONTENT for p in patterns["parts"].findall(value))
            if any(names_boiler(token, weak, in_content, patterns) for token in value.split()):
                return True
    return False


def names_boiler(token: str, weak: bool, in_content: bool, patterns) -> bool:
    """Does this one token of a class or id name boilerplate?

    Inside <article> or <main> all its words must (top-menu, share-buttons, but not related-work); elsewhere a word of
    LAYOUT is enough, or any other as long as the last word, which says what the thing is, is one or FURNITURE."""
    words = [p.lower() for p in patterns["parts"].findall(token)]
    if NEGATED.intersection(words):
        return False                                  # has-sidebar, no-comments: said of what is beside the element
    words = [w for w in words if w in STRONG or len(w) > 2 and not w.isdigit()]      # not js-, wp-, 300x250
    named = [w in STRONG or weak and w in WEAK for w in words]
    fits = [n or w in FURNITURE or w in WEAK for n, w in zip(named, words)]
    return any(named) and (all(fits) if in_content else fits[-1] or not LAYOUT.isdisjoint(words))


HOLDERS = frozenset("article main section div td".split())


def tokens_of(html: str, patterns) -> tuple[list[tuple], list[tuple]]:
    """(tokens, holders) in page order.

    A token is (word class or "tag", text or tag name, innermost holder or, for tags, whether it opens).
    A holder is an element that may hold the content: (name, number of the holder around it or -1)."""
    from collections import Counter
    from html import unescape
    out: list[tuple] = []
    holders: list[tuple] = []
    stack: list[tuple] = []                           # (name, boilerplate, innermost holder, in content)
    opened = Counter()                                # names on the stack: a stray closing tag is not searched for
    link, at = False, 0

    def put(text):
        if text and not text.isspace():
            kind = "boiler" if stack and stack[-1][1] else "link" if link else "plain"
            out.append((kind, unescape(text), stack[-1][2] if stack else -1))
        elif text:
            out.append(("space", " ", -1))

    for m in patterns["token"].finditer(html):
        put(html[at:m.start()])
        at = m.end()
        if m[3] is None:
            continue                                  # comment, raw element, doctype, or a tag that is cut off
        name, closes = m[3].lower(), bool(m[2])
        _, boiler, holder, content = stack[-1] if stack else ("", False, -1, False)
        if name == "a":
            link = not closes
        if name == "td" or name not in LOOSE and name not in VOID:
            if closes:
                if opened[name]:
                    link = False
                    while (ended := stack.pop()[0]) != name:
                        opened[ended] -= 1
                    opened[name] -= 1
            elif not m[4].rstrip().endswith("/"):
                boiler = boiler or is_boiler(name, m[4], content, patterns)
                if name in HOLDERS and not boiler:
                    holders.append((name, holder))
                    holder = len(holders) - 1
                stack.append((name, boiler, holder, content or name in ("article", "main") and not boiler))
                opened[name] += 1
        out.append(("tag", name, not closes))
    put(html[at:])
    return out, holders


def widened(tokens: list[tuple], holders: list[tuple], start: int, end: int) -> tuple[int, int]:
    """The run's bounds, moved out to those of the element that holds it.

    Two things need this: a heading or closing line of fewer words than its tags cost, and a block
    of boilerplate inside the content that costs more than the text beyond it scores."""
    from heapq import heapify, heappop, heappush
    around = {t[2] for t in tokens[start:end] if t[0] == "plain"}
    latest = [-h for h in around]
    heapify(latest)
    while len(latest) > 1:                            # an element comes after the one around it: the last gives way to its outer one
        outer = holders[-heappop(latest)][1]
        if outer < 0:
            return start, end
        if outer not in around:
            around.add(outer)
            heappush(latest, -outer)
    common = -latest[0] if latest else -1
    if common < 0:
        return start, end
    own = common
    while own >= 0 and holders[own][0] not in ("article", "main"):
        own = holders[own][1]
    own = common if own < 0 else own
    held = [False] * len(holders)
    for h, (_, outer) in enumerate(holders):
        held[h] = h == own or outer >= 0 and held[outer]
    inside = [i for i, t in enumerate(tokens) if t[0] in ("plain", "link") and t[2] >= 0 and held[t[2]]]
    return min(start, inside[0]), max(end, inside[-1] + 1)


def best_run(scores: list[float]) -> tuple[int, int]:
    """Start and end (exclusive) of the contiguous run of highest positive sum; the first of ties, (0, 0) if none."""
    best, best_at, total, start = 0.0, (0, 0), 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, start = 0.0, i
        total += s
        if total > best:
            best, best_at = total, (start, i + 1)
    return best_at


def scores_of(tokens: list[tuple], weights: dict[str, float]) -> list[float]:
    return [0.0 if kind == "space" else weights.get(f"tag:{text}", weights["tag"]) if kind == "tag"
            else weights[kind] * len(text.split()) for kind, text, _ in tokens]


def main_text(html: str | None, weights: dict[str, float], patterns) -> str:
    tokens, holders = tokens_of(html or "", patterns)
    start, end = widened(tokens, holders, *best_run(scores_of(tokens, weights)))
    blocks, parts = [], []
    for kind, text, _ in tokens[start:end]:
        if kind == "tag":
            if text in INLINE:
                if text in ("br", "td", "th"):
                    parts.append(" ")
            else:
                blocks.append("".join(parts))
                parts = []
        elif kind != "boiler":
            parts.append(text)
    blocks.append("".join(parts))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def learn(df: DataFrame, id_col: str = "page_id", html_col: str = "html", pages: int = TRAIN_PAGES) -> dict[str, float]:
    """Scores of the token classes from labelled pages (the defaults where there are none)."""
    labelled = df.where(F.col(html_col).rlike(r"(?i)<(article|main)[\s>]"))
    n = labelled.count()

    def count(batches: Iterator) -> Iterator:
        from collections import Counter

        import pyarrow as pa
        patterns, seen = compiled(), Counter()
        for batch in batches:
            for html in batch.column(0).to_pylist():
                depth = 0
                for kind, text, opens in tokens_of(html, patterns)[0]:
                    if kind == "tag":
                        depth = max(0, depth + (1 if opens else -1)) if text in ("article", "main") else depth
                        seen[f"tag:{text[:16]}", depth > 0] += 1
                    elif kind != "space":
                        seen[kind, depth > 0] += len(text.split())
        keys = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in keys], pa.string()), pa.array([i for _, i in keys], pa.bool_()),
                                          pa.array([seen[k] for k in keys], pa.int64())], names=["class", "inside", "n"])

    sample = labelled.where(F.pmod(F.xxhash64(id_col), F.lit(max(1, n // max(1, pages)))) == 0)
    counts = sample.select(F.col(html_col).alias("html")).mapInArrow(count, "class string, inside boolean, n long").groupBy("class").agg(
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("a"), F.sum("n").alias("n")).collect()      # classes of the sample's pages
    return weights_of({r["class"]: (r.a, r.n) for r in counts})


def weights_of(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """class -> (number inside content, number) to class -> score."""
    import math
    weights = dict(DEFAULT)
    for name, (inside, n) in counts.items():
        share = (inside + 1) / (n + 2)
        if name.startswith("tag:"):
            weights[name] = -(0.2 + 4.0 * (1 - share))       # never positive; -0.2 where all are content
        else:
            weights[name] = max(-4.0, min(4.0, math.log(share / (1 - share))))
    weights["plain"] = max(weights["plain"], 0.5)
    weights["boiler"] = min(weights["boiler"], -0.5)
    return weights


def extract(df: DataFrame, weights: dict[str, float] | None = None, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of each page."""
    weights = weights or learn(df, id_col, html_col)

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        patterns = compiled()
        for batch in batches:
            texts = [main_text(h, weights, patterns) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    return df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long")

"""HTML main text as a maximum-scoring subsequence: words score 1 and tags negative, one linear scan finds the region.

How much a tag costs is learned from labelled pages, those with one article element: a tag seldom met inside articles and often
outside or at their edge costs much. Menus, headers, footers, adverts, forms, notices, comments and hidden parts bring
no words; their tags still cost. The blocks of the best contiguous region are the text.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound on the labelled pages that tag costs are fitted on, as the expected size of a hash-chosen sample.
MOST_LABELLED = 4000
WORD_SCORE = 1.0
#: Costs in words: the least and most of a tag, of a tag in a part that is left out, and of one unit of log odds. The edges of an article or main part have no most.
LEAST_COST, MOST_COST, OUT_COST, COST_SCALE = 0.02, 4.0, 0.2, 100.0
EDGES = frozenset(("article", "main"))

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "template", "iframe", "noembed", "noframes", "xmp")
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var br wbr".split())
SKIPPED = frozenset("nav header footer aside form script style noscript template iframe object embed svg math canvas audio video map button select option textarea input label fieldset dialog menu head title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: These, when an article begins inside them, were wrappers of the whole page.
WRAPPERS = frozenset("nav header footer form fieldset menu".split())

_MARKED = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner|sponsor\w*|promo\w*|breadcrumbs?|navbar|nav|navigation|menu|topbar|sidebar|side|widget|footer|masthead|header|cookies?|consent|gdpr|notice|alert|popup|modal|overlay|newsletter|subscribe|signup|login|share|sharing|social|related|recommended|comments?|commentlist|respond|replies|reply|disqus\w*|skip|toolbar|pagination|pager)(?:$|[\s_-])",
    re.I,
)
_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([A-Za-z][A-Za-z0-9:-]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*?)(?:>|\Z)|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>])[^>]*(?:>|\Z)", re.I) for name in RAW}
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _is_marked(name: str, attributes: str) -> bool:
    """Whether class, id, role or style say that the element is no part of the article."""
    if not attributes.strip():
        return False
    found = {k.lower(): next((v for v in rest if v), "") for k, *rest in _ATTRIBUTE.findall(attributes)}
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or _HIDDEN.search(found.get("style", "")):
        return True
    if name in ("html", "body", "article", "main") and not re.search(r"comment|reply", f"{found.get('class', '')} {found.get('id', '')}", re.I):
        return False
    return found.get("role", "").lower() in _ROLES or any(_MARKED.search(found.get(k, "")) for k in ("class", "id"))


def events(page: str) -> Iterator[tuple[str, str, bool]]:
    """(kind, value, skipped) in page order: kind is 'open', 'close' or 'text'; skipped: inside a part that is no article.

    Tags may be unclosed, misnested or cut off. An end tag closes what it finds open; what it doesn't find it leaves alone.
    """
    stack: list[tuple[str, bool]] = []
    opened: Counter[str] = Counter()
    skipping, at, n = 0, 0, len(page)

    def close_to(depth: int) -> None:
        nonlocal skipping
        while len(stack) > depth:
            name, skips = stack.pop()
            opened[name] -= 1
            skipping -= skips

    while at < n:
        m = _TOKEN.match(page, at)
        at = m.end()
        if m[2] is None:
            text = m[0]
            if text[:4] == "<!--" or (text[:1] == "<" and len(text) > 1 and text[1] in "!?" and text[:9] != "<![CDATA["):
                continue
            if text[:9] == "<![CDATA[":
                text = text[9:].removesuffix("]]>").replace("&", "&amp;")
            yield "text", text, skipping > 0
            continue
        name = m[2].lower()
        if m[1]:
            for depth in range(len(stack) - 1, -1, -1) if opened[name] else ():
                if stack[depth][0] == name:
                    close_to(depth)
                    break
                if stack[depth][0] in ("article", "main", "body", "table") and (name in INLINE or name in ("p", "li")):
                    break
            yield "close", name, skipping > 0
            continue
        if name in EDGES and skipping and not _is_marked(name, m[3]):
            if all(x in WRAPPERS for x, skips in stack if skips):
                skipping, stack[:] = 0, [(x, False) for x, _ in stack]
        if name in BLOCK and stack and stack[-1][0] == "p":
            close_to(len(stack) - 1)
        if name in ("li", "dt", "dd", "tr", "td", "th", "option") and stack and stack[-1][0] == name:
            close_to(len(stack) - 1)
        in_article = opened["article"] or opened["main"]
        skips = (name in SKIPPED and not (name in ("header", "label") and in_article)) or _is_marked(name, m[3])
        yield "open", name, skipping > 0 or skips
        if name in _RAW_END:
            end = _RAW_END[name].search(page, at)
            at = end.end() if end else n
            yield "close", name, skipping > 0 or skips
        elif name not in VOID and not m[3].rstrip().endswith("/"):
            stack.append((name, skips))
            opened[name] += 1
            skipping += skips


def best_region(scores: list[float]) -> tuple[int, int]:
    """[begin, end) of the contiguous stretch with the largest sum, the first and longest of equal ones; empty if none is over 0."""
    best, begin, end, run, start = 0.0, 0, 0, 0.0, 0
    for k, x in enumerate(scores):
        if run <= 0:
            run, start = 0.0, k
        run += x
        if run > best or (run == best and begin == start and end):
            best, begin, end = run, start, k + 1
    return begin, end


def cost(name: str, kind: str, skipped: bool, costs: dict[str, float]) -> float:
    """What a tag costs; one that no labelled page has: as much as an inline element, a block or a foreign element usually do."""
    if skipped:
        return OUT_COST
    learned = costs.get(f"{kind} {name}")
    if learned is None:
        return COST_SCALE if name in EDGES else LEAST_COST if name in INLINE else 5 * LEAST_COST if name in BLOCK else 1.0
    return learned


def main_text(page: str, costs: dict[str, float]) -> str:
    """The article's blocks, each with single spaces, joined by an empty line."""
    parts = list(events(page))
    scores = [(WORD_SCORE * len(value.split()) if not skipped else 0.0) if kind == "text" else -cost(value, kind, skipped, costs) for kind, value, skipped in parts]
    begin, end = best_region(scores)
    blocks, now = [], []
    for kind, value, skipped in parts[begin:end]:
        if kind == "text":
            if not skipped:
                now.append(value)
        elif value in BLOCK:
            blocks.append(now)
            now = []
        elif value == "br":
            now.append(" ")
    blocks.append(now)
    joined = (" ".join(entities.unescape("".join(b)).split()) for b in blocks)
    return "\n\n".join(b for b in joined if b)


def _tag_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each tag stands within an article, and how often outside or at its edge."""
    known = BLOCK | INLINE | SKIPPED | VOID
    for batch in batches:
        inside, outside = Counter(), Counter()
        for page in batch.column(0).to_pylist():
            depth = 0
            for kind, name, skipped in events(page or ""):
                if kind == "text" or skipped or name not in known:
                    continue
                edge = name == "article"
                depth += (kind == "open") - (kind == "close") if edge else 0
                (inside if depth > 0 and not edge else outside)[f"{kind} {name}"] += 1
        names = sorted(inside.keys() | outside.keys())
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([inside[x] for x in names], pa.int64()), pa.array([outside[x] for x in names], pa.int64())], ["tag", "inside", "outside"])


def fit_costs(pages: DataFrame, html_col: str = "html", id_col: str = "page_id", most: int = MOST_LABELLED) -> dict[str, float]:
    """Cost of each tag, from a sample of about `most` pages at most that have one article element, chosen by a hash of their ids.

    A tag costs COST_SCALE times its log odds of standing outside, within bounds. Tags in parts that are left out anyway teach nothing.
    """
    n_articles = F.regexp_count(F.col(html_col), F.lit(r"(?i)<article[\s>]"))
    labelled = pages.where(n_articles == 1)
    share = most / max(most, labelled.count())
    chosen = labelled.where(F.conv(F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") < share * 2.0**32)
    counts = chosen.select(html_col).mapInArrow(_tag_counts, "tag string, inside long, outside long").groupBy("tag").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
    return learned_costs({r["tag"]: (r["inside"], r["outside"]) for r in counts.collect()})  # the names of HTML at most


def learned_costs(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    costs = {tag: max(LEAST_COST, COST_SCALE * math.log((outside + 1) / (inside + 1))) for tag, (inside, outside) in counts.items()}
    return {tag: x if tag.split()[1] in EDGES else min(MOST_COST, x) for tag, x in costs.items()}


def _extracted(costs: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x, costs) if x else "" for x in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return run


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of pages: page_id, url, text (empty if there is none; null html is empty), n_chars (code points).

    Pages need not be whole or well formed; rows that repeat give rows that repeat. An empty table gives an empty result.
    """
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    return slim.mapInArrow(_extracted(fit_costs(slim, "html", "page_id")), "page_id long, url string, text string, n_chars long")

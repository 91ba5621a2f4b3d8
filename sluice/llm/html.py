"""Main text of web pages by a maximum-scoring subsequence.

A page is a line of words and tags. Words score by where they stand, tags score negative, both with weights
taken from labelled pages: those that mark their content by one article or main element. One linear scan
finds the contiguous region of the highest sum; what boilerplate it still holds (known elements, classes and
roles) is left out, and the rest is returned as blocks.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import pyspark.sql.functions as F
from pyspark.sql import DataFrame

from sluice.llm import files

LABELLED_PAGES = 500  # bound of the sample that the weights are fitted on
CLIP = 4.0

# Element names of the markup language and words that sites use for boilerplate.
RAW = "script|style|noscript|template|textarea|iframe|svg|math|object|select|canvas|audio|video"
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6"}
SIBLINGS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
CONTENT = {"article", "main"}
BOILERPLATE = set("nav footer aside form head title menu dialog button".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alert".split())
BOILERPLATE_WORD = re.compile(
    r"(?:^|[-_])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|comments?|disqus|replies|nav\w*|menu|breadcrumbs?|side-?bar|"
    r"cookies?|consent|notices?|gdpr|popup|modal|newsletter|subscribe|signup|footer|masthead|site-?header|pagination|pager|widget|toolbar)(?:$|[-_])"
    r"|^(?:share|sharing|social|related|recommend\w*)(?:$|[-_])",
    re.I,
)
COMMENT_WORD = re.compile(r"(?:^|[-_])(?:comments?|disqus|replies)(?:$|[-_])", re.I)
MODIFIER = re.compile(r"(?:has|no|not|with|without|is|hide|js)[-_]", re.I)  # "has-sidebar" says something of an element, not what it is
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})\b(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][\w:-]*+)(?P<rest>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*+(?:>|\Z))"
    r"|</[^>]*+(?:>|\Z)",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)


HARD, SOFT = 2, 1  # boilerplate by name, role or as reader comments; boilerplate by a class or id alone


def _keyed(name: str, rest: str) -> tuple[str, int]:
    """An element's key (name and classes) and whether it is boilerplate: HARD, SOFT or 0."""
    found = {k.lower(): (a or b or c).strip() for k, a, b, c in ATTRIBUTE.findall(rest)} if "=" in rest else {}
    key = ".".join([name, *sorted(found.get("class", "").lower().split())])
    if name in BOILERPLATE or found.get("role", "").lower() in ROLES:
        return key, HARD
    words = [] if name in ("html", "body", *CONTENT) else f"{found.get('class', '')} {found.get('id', '')}".split()
    words = [w for w in words if not MODIFIER.match(w)]
    if any(COMMENT_WORD.search(w) for w in words):
        return key, HARD
    return key, SOFT if any(BOILERPLATE_WORD.search(w) for w in words) else 0


def events(page: str) -> Iterator[tuple]:
    """("text", key, boilerplate, block, text, inside, around, hard) and ("tag", key, inside), in page order.

    A text's key is its nearest block element and the nearest named section around it. ``inside`` says
    whether an article or main element is open. An element that is boilerplate by a class alone makes a text so unless
    an article or main element stands between them; ``around`` has the numbers of such elements that are open around the
    text and, if there is one, its article.
    """
    stack: list[tuple[str, str, int, int]] = []  # open block elements: name, key, boilerplate, number
    block = at = 0
    inside = 0

    def text_event(text):
        inner = stack[-1][1] if stack else ""
        section = next((k for n, k, _, _ in reversed(stack[:-1]) if n not in CONTENT and n not in ("html", "body", "ul", "ol", "div", "section")), "")
        named = next((k for _, k, _, _ in reversed(stack[:-1]) if "." in k), section)
        opened = next((d for d in range(len(stack) - 1, -1, -1) if stack[d][0] in CONTENT), -1)
        hard = any(b == HARD for _, _, b, _ in stack) or any(b == SOFT for _, _, b, _ in stack[opened + 1 :] if opened >= 0)
        around = tuple(number for _, _, b, number in (stack if opened < 0 else stack[:opened]) if b == SOFT)
        return ("text", f"{inner} in {named}", hard or (opened < 0 and bool(around)), block, text, inside > 0, () if hard else around, hard)

    def leave(names):
        """Close open elements down to one of these names, if there is one."""
        nonlocal inside
        for depth in range(len(stack) - 1, -1, -1):
            if stack[depth][0] in names:
                for name, *_ in stack[depth:]:
                    inside -= name in CONTENT
                del stack[depth:]
                return

    for m in TOKEN.finditer(page):
        if m.start() > at:
            yield text_event(page[at : m.start()])
        at = m.end()
        name = m["name"]
        if not name:
            continue
        name = name.lower()
        if name not in BLOCKS:
            yield ("tag", ("/" if m["close"] else "") + name, inside > 0)
            if name == "br":
                yield text_event(" ")
            elif name == "button":
                block += 1
            continue
        block += 1
        if m["close"]:
            yield ("tag", "/" + name, inside > 0)
            leave({name})
            continue
        if stack and stack[-1][0] in CLOSED_BY_BLOCKS:
            leave({stack[-1][0]})
        if name in SIBLINGS and stack and stack[-1][0] in SIBLINGS[name]:
            leave({stack[-1][0]})
        key, known = _keyed(name, m["rest"] or "")
        if name == "header" and not inside:
            known = HARD
        yield ("tag", key, inside > 0)
        if name not in VOID:
            stack.append((name, key, known, block))
            inside += name in CONTENT
    if at < len(page):
        yield text_event(page[at:])


def count_labels(page: str) -> Counter:
    """Words by (kind, key, inside) of a page that marks its content by one element, else nothing."""
    low = page.lower()
    if low.count("<article") + low.count("<main") != 1:
        return Counter()
    counts: Counter = Counter()
    for event in events(page):
        if event[0] == "text":
            counts["word", event[1], event[5]] += len(event[4].split())
        elif event[1].lstrip("/") not in CONTENT:
            counts["tag", event[1], event[2]] += 1
    return counts


class Weights:
    """Scores of words and tags; without labelled pages they are those of plain words and tags."""

    def __init__(self, counts: dict[tuple[str, str, bool], int]):
        self.word: dict[str, float] = {}
        self.tag: dict[str, float] = {}
        for (kind, key, _), _n in counts.items():
            inner, outer = counts.get((kind, key, True), 0), counts.get((kind, key, False), 0)
            odds = max(-CLIP, min(CLIP, math.log((inner + 0.5) / (outer + 0.5))))
            if kind == "word":
                self.word[key] = odds / CLIP
            else:
                self.tag[key] = -0.05 + min(0.0, odds)

    def of_word(self, key: str, boilerplate: bool) -> float:
        return self.word.get(key, -0.5 if boilerplate else 0.5)

    def of_tag(self, key: str) -> float:
        return 0.0 if key.lstrip("/") in CONTENT else self.tag.get(key, -0.5)


def main_text(page: str | None, weights: Weights) -> str:
    """The best region's blocks, joined by line feeds; empty for null, empty and wordless pages."""
    texts: list[tuple] = []
    best = total = 0.0
    first, best_first, best_last = 0, 0, 0
    for event in events(page or ""):
        if event[0] == "text":
            texts.append(event)
            score = weights.of_word(event[1], event[2]) * len(event[4].split())
        else:
            score = weights.of_tag(event[1])
        if total <= 0:
            total, first = 0.0, len(texts) - (event[0] == "text")
        total += score
        if total > best:
            best, best_first, best_last = total, first, len(texts)
    region = [t for t in texts[best_first:best_last] if not t[7]]
    held: Counter = Counter()
    for t in region:
        for number in t[6]:
            held[number] += len(t[4].split())
    # a class does not make boilerplate of the element that holds most of the region, or all that is an article
    most = sum(len(t[4].split()) for t in region)
    dropped = {number for number, n in held.items() if 2 * n <= most}
    blocks: dict[int, list[str]] = {}
    for _, _, _, block, text, _, around, _ in region:
        if not dropped.intersection(around):
            blocks.setdefault(block, []).append(html.unescape(text))
    lines = (" ".join("".join(parts).split()) for parts in blocks.values())
    return "\n".join(line for line in lines if line)


def fit(pages: DataFrame, bound: int = LABELLED_PAGES) -> Weights:
    """Weights from at most ``bound`` labelled pages, chosen by a hash of their html; copies count once.

    The least hashes are chosen first, so only pages of the sample are sent on.
    """
    marked = pages.select("html", F.xxhash64("html").alias("key")).where(F.lower("html").rlike("<(article|main)"))
    keys = [r.key for r in marked.select("key").distinct().orderBy("key").limit(bound).collect()]
    sample = marked.where(F.col("key").isin(keys)).groupBy("key").agg(F.first("html").alias("html")).select("html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for page in batch["html"].to_pylist():
                counts.update(count_labels(page))
        if counts:
            kinds, keys, inner = zip(*counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds), pa.array(keys), pa.array(inner), pa.array(list(counts.values()))], names=["kind", "key", "inside", "n"]
            )

    rows = sample.mapInArrow(run, "kind string, key string, inside boolean, n long").groupBy("kind", "key", "inside").agg(F.sum("n").alias("n")).collect()
    return Weights({(r.kind, r.key, r.inside): r.n for r in rows})


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """One row per page: page_id, url, text. Null html is empty; repeated pages are returned each, and an empty table gives none.

    Pages are read whole, however long; of regions that score alike the first is taken. Other columns are not read.
    """
    source = pages.select("page_id", "url", "html")
    schema = source.select("page_id", "url").schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in files.chunks_of(batches, "html"):
            texts = [main_text(page, weights) for page in batch["html"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["page_id"], batch["url"], pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    return source.mapInArrow(run, schema)

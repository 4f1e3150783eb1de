"""Main text of web pages by tag-path ratios.

A page is read once into blocks (runs of text not parted by block elements),
each with its root-to-leaf path of block tags and their first class. Per path
the text length, the punctuation and the link text of its blocks are summed;
length and punctuation per block and the share of text outside links are fused
into the path's score. The scores of the blocks in page order are smoothed with
a Gaussian, and blocks above a share of the page's text-weighted mean score are
selected; all of them stay. They name the container of the article, the deepest
element that holds them all; the headings and short paragraphs in it belong to
the article too.

An <article> or <main> (tag or role) selects nothing by itself. If one holds at
least half of the page's scored text, the scores of its blocks are doubled, and
the container is that element if it would lie inside it.

Scripts, controls and hidden elements are left out before. So are elements that
stand beside an article by their tag or role (navigation, footers and so on) if
they are closed, and forms, but for one that holds the page's largest article or
main, or half of its scored text (it wraps the page). Elements named like reader
comments are left out, and have no say in the scores, where there is other text.
Any other class name or id of page furniture (adverts, sidebars and so on) drops nothing: it takes the scores of
the blocks in it, and their weight in the mean, to a tenth, so they lose against
other text but stay where there is none; it does not count for an element that
holds the page's largest article or main, or half of the scored text of a page
without one (names of comments: see ``penalised``).

A selected block is never dropped for its links if the rest of its element, on the
same path, is article text: a paragraph or item that is one link stays.

Defined results: null or empty pages, and pages without article text, give an
empty text; unclosed, stray or cut-off tags are tolerated; a page without tags
is one block; repeated rows get a row each; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from codefacts.llm.common import computed

# HTML's element classes.
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes", "template"}
SKIPPED = {"head", "button", "select", "option", "datalist", "dialog", "svg", "math", "object", "canvas", "audio",
           "video", "map", "fieldset", "label", "input"}
BESIDE = {"nav", "footer", "aside", "menu", "form"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
          "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var", "wbr", "br", "img"}
CLOSES = {"p": {"p"}, "li": {"p", "li"}, "dt": {"p", "dt", "dd"}, "dd": {"p", "dt", "dd"},
          "tr": {"p", "td", "th", "tr"}, "td": {"p", "td", "th"}, "th": {"p", "td", "th"}}
KEEPS_P = {"button", "td", "th", "li", "dd", "object"}
TEXTUAL = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "dd", "dt", "figcaption",
           "caption", "address", "summary"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu",
         "menubar", "toolbar", "form", "tablist"}

# Parts of class names and ids (between hyphens, underscores and capitals).
NAMED = set("""ad ads advert adverts advertisement advertisements advertising advertorial adsense adslot banner banners
    sponsor sponsors sponsored sponsorship promo promos promoted promotion promotions promotional cookie cookies consent
    gdpr notice notices alert alerts newsletter subscribe subscriber subscribers subscription subscriptions sidebar
    sidebars side aside rail nav navbar navigation menu menus breadcrumb breadcrumbs footer footers foot masthead topbar
    toolbar header comment comments commentlist respond replies disqus discussion share shares sharing sharer sharebar
    sharethis social related recommend recommends recommended recommendation recommendations popular trending popup
    popups modal overlay pagination pager widget widgets login signin signup search disclaimer copyright skip skiplink
    hidden outbrain taboola""".split())
LAYOUT = {"has", "no", "with", "without"}       # say what an element has beside it, not what it is
CONTENT = {"article", "main", "content", "post", "entry", "story", "body", "page"}
SURE = {"sidebar", "sidebars", "side", "aside", "footer", "footers", "foot", "nav", "navbar", "navigation", "menu",
        "menus", "share", "shares", "sharing", "sharer", "sharebar", "sharethis", "related"}
TALK = {"comment", "comments", "commentlist", "respond", "replies", "disqus", "discussion"}
PART = re.compile(r"[a-z0-9]+|[A-Z]+(?![a-z])|[A-Z][a-z0-9]*|[^\W_A-Za-z0-9]+")
TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|"""
                 r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^<>]*+)(?:>|\Z|(?=<))""", re.S)
ATTR = re.compile(r"""\s(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
BONUS = 2.0     # of the blocks in the page's own article or main
PENALTY = 0.1   # of the blocks in an element that is named like page furniture
PUNCT = re.compile(r"[.,;:!?…。，；：！？、]")


def furniture(names: str) -> int:
    """1 if class names and id say page furniture, 2 if they say comments."""
    parts, said = set(), set()
    for name in names.split():
        own = {p.lower() for p in PART.findall(name)} | ({"related"} if "more-stories" in name.lower() else set())
        parts |= own
        if not own & LAYOUT:
            said |= own & NAMED
    if not said or (parts & CONTENT and not said & (SURE | TALK)):
        return 0
    return 2 if said & TALK else 1


class Page:
    """Blocks of one page. ``elements``: parent index; ``paths``: interned tag paths;
    ``named``: ``furniture`` of the elements that have one."""

    def __init__(self, html: str):
        self.parent, self.blocks, self.paths, self.named = [-1], [], {}, {}
        self.beside, self.closed = {}, set()            # elements of BESIDE with their tag; closed elements
        self.stack = [("#root", 0, 0, False, 0)]        # tag, element, path, dropped, outermost article or main
        self.text, self.link, self.links = [], 0, 0
        self.read(html)

    def read(self, html: str) -> None:
        at = 0
        while m := TAG.search(html, at):
            if m.start() > at:
                self.put(html[at:m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                continue
            tag = tag.lower()
            if m[1] or m[4]:
                self.close(tag)
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
                at = end.end() if end else len(html)
            else:
                self.open(tag, m[3] or m[6] or "")
        self.put(html[at:])
        self.flush()

    def put(self, raw: str) -> None:
        top = self.stack[-1]
        if not top[3]:
            self.text.append(raw)
            if self.links:
                self.link += len(raw)

    def flush(self) -> None:
        """End the block that is being read."""
        if self.text:
            clean = " ".join(unescape("".join(self.text)).split())
            if clean:
                tag, element, path, _, content = self.stack[-1]
                self.blocks.append((clean, element, path, tag, min(self.link, len(clean)), content))
            self.text, self.link = [], 0

    def open(self, tag: str, attrs: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.links = 1
            elif tag == "br":
                self.put(" ")
            return
        self.flush()
        if tag in VOID:
            return
        for i in range(len(self.stack) - 1, 0, -1):       # implied end tags
            name = self.stack[i][0]
            if name in CLOSES.get(tag, {"p"}):
                del self.stack[i:]
            elif name in KEEPS_P or name not in CLOSES:
                break
        _, parent, path, dropped, content = self.stack[-1]
        found = {a[0].lower(): a[1] or a[2] or a[3] for a in ATTR.findall(attrs)} if attrs else {}
        names = f"{found.get('class', '')} {found.get('id', '')}"
        self.parent.append(parent)
        own = content
        if not own and (tag in ("article", "main") or found.get("role", "").lower() in ("main", "article")):
            own = len(self.parent) - 1
        if not dropped:
            hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true" \
                or "display:none" in found.get("style", "").replace(" ", "").lower()
            dropped = bool(tag in SKIPPED or hidden)
            role = found.get("role", "").lower()
            if tag in BESIDE or role in ROLES or (tag == "header" and not own):
                self.beside[len(self.parent) - 1] = "form" if tag == "form" and role != "search" or role == "form" else tag
        named = 0
        if names != " " and not dropped and tag not in ("html", "body", "main"):
            named = furniture(names)
            if named == 1 and tag == "article":
                named = 0
            if named:
                self.named[len(self.parent) - 1] = named
        step = (path, tag + "." + found["class"].split()[0] if found.get("class", "").strip() else tag, named)
        self.stack.append((tag, len(self.parent) - 1, self.paths.setdefault(step, len(self.paths) + 1), dropped, own))

    def close(self, tag: str) -> None:
        if tag in INLINE:
            if tag == "a":
                self.links = 0
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                self.closed.add(self.stack[i][1])
                self.flush()
                del self.stack[i:]
                self.links = 0
                return


def path_scores(blocks) -> dict[int, float]:
    """Fused ratio of each tag path: text and punctuation per block, outside links."""
    sums: dict[int, list[int]] = {}
    for text, _, path, _, link, _ in blocks:
        s = sums.setdefault(path, [0, 0, 0, 0])
        s[0] += 1
        s[1] += len(text)
        s[2] += len(PUNCT.findall(text))
        s[3] += link
    return {p: math.log1p(chars / n) * math.log1p(1 + punct / n) * (1 - link / chars)
            for p, (n, chars, punct, link) in sums.items()}


def smoothed(x: list[float]) -> list[float]:
    """Gaussian of radius 1, edges repeated."""
    padded = [x[0], *x, x[-1]]
    return [.25 * a + .5 * b + .25 * c for a, b, c in zip(padded, padded[1:], padded[2:])]


def container(parent: list[int], blocks, chosen: list[bool], own: int) -> int:
    """The deepest element that holds all chosen blocks (the block elements
    themselves are not containers), or the page's own article ``own`` if that
    element lies in it."""
    mass = [0] * len(parent)
    for b, c in zip(blocks, chosen):
        if c:
            mass[max(parent[b[1]], 0)] += 1
    total = sum(mass)
    for e in range(len(parent) - 1, 0, -1):
        mass[parent[e]] += mass[e]
    best = max((e for e in range(len(parent)) if mass[e] == total), default=0) if total else 0
    up = best
    while up > own:
        up = parent[up]
    return own if own and up == own else best


def home(blocks, scores: list[float], share: float = 0.5) -> int:
    """The outermost article or main element that holds most of the scored text
    of all such, if it holds at least ``share`` of the page's; 0 otherwise."""
    mass: dict[int, float] = {}
    for b, x in zip(blocks, scores):
        mass[b[5]] = mass.get(b[5], 0) + x * len(b[0])
    total = sum(mass.values())
    return max((e for e in mass if e and mass[e] >= share * total), key=lambda e: mass[e], default=0)


def weights(page: Page, blocks, scores: list[float]) -> list[float]:
    """Scored text in each element."""
    mass = [0.0] * len(page.parent)
    for b, x in zip(blocks, scores):
        mass[b[1]] += x * len(b[0])
    for e in range(len(mass) - 1, 0, -1):
        mass[page.parent[e]] += mass[e]
    return mass


def scored(blocks) -> list[float]:
    of = path_scores(blocks)
    return [of[b[2]] for b in blocks]


def without(page: Page, blocks, gone: set[int]):
    """The blocks that lie in none of the elements ``gone``."""
    inside = [False] * len(page.parent)
    for e in range(1, len(inside)):
        inside[e] = e in gone or inside[page.parent[e]]
    return [b for b in blocks if not inside[b[1]]]


def article_blocks(page: Page):
    """The page's blocks without closed elements that stand beside an article,
    without forms that do not wrap the page, and without reader comments where
    there is other text."""
    left = without(page, page.blocks, {e for e, tag in page.beside.items() if tag != "form" and e in page.closed})
    forms = {e for e, tag in page.beside.items() if tag == "form"}
    if forms:
        scores = scored(left)
        mass, up, wraps = weights(page, left, scores), home(left, scores, 0), set()
        while up > 0:
            wraps.add(up)
            up = page.parent[up]
        left = without(page, left, {e for e in forms if e not in wraps and 2 * mass[e] < mass[0]})
    if 2 in page.named.values():
        depth, talk = penalised(page, left, scored(left))
        other = without(page, left, talk)
        if any(depth[b[1]] == 0 for b in other):
            left = other
    return left


def penalised(page: Page, blocks, scores: list[float]) -> tuple[list[int], set[int]]:
    """The number of elements named like furniture around each element, itself
    included, and the elements named like comments among those. The name of an element that holds the page's largest article or
    main, or half of the scored text of a page without one, does not count; that
    of comments counts unless it holds such an article and half of the text."""
    parent = page.parent
    mass, largest, up = [0.0] * len(parent), set(), home(blocks, scores, 0)
    if page.named:
        mass = weights(page, blocks, scores)
        while up > 0:
            largest.add(up)
            up = parent[up]
    depth, talk = [0] * len(parent), set()
    for e in range(1, len(parent)):
        named, half = page.named.get(e, 0), 2 * mass[e] >= mass[0]
        spared = e in largest and (half or named == 1) if largest else half and named == 1
        depth[e] = depth[parent[e]] + (named > 0 and not spared)
        if named == 2 and not spared:
            talk.add(e)
    return depth, talk


def main_text(html: str | None, threshold: float = 0.5) -> str:
    page = Page((html or "").replace("\x00", ""))
    blocks = article_blocks(page)
    if not blocks:
        return ""
    scores = scored(blocks)
    depth, _ = penalised(page, blocks, scores)
    least, groups = min(depth[b[1]] for b in blocks), {}
    for i, b in enumerate(blocks):                  # smoothed among blocks of equal penalty
        groups.setdefault(depth[b[1]] - least, []).append(i)
    fused, worth = [0.0] * len(blocks), [0.0] * len(blocks)
    for d, at in groups.items():
        for i, f in zip(at, smoothed([scores[i] for i in at])):
            fused[i], worth[i] = f * PENALTY ** d, len(blocks[i][0]) * PENALTY ** d
    own = home(blocks, fused)
    if own:
        fused = [BONUS * f if b[5] == own else f for f, b in zip(fused, blocks)]
    bar = threshold * sum(f * w for f, w in zip(fused, worth)) / sum(worth)
    mostly_links = [2 * b[4] > len(b[0]) for b in blocks]
    chosen = [f >= bar and not linky for f, linky in zip(fused, mostly_links)]
    best = container(page.parent, blocks, chosen, own)
    inside = {best}
    for e in range(best + 1, len(page.parent)):
        if page.parent[e] in inside and depth[e] == depth[best]:
            inside.add(e)
    taken = [c or not linky and b[1] in inside and b[3] in TEXTUAL for b, c, linky in zip(blocks, chosen, mostly_links)]
    like = {(page.parent[b[1]], b[2]) for b, t in zip(blocks, taken) if t}
    kept = [b[0] for b, t in zip(blocks, taken) if t or b[3] in TEXTUAL and (page.parent[b[1]], b[2]) in like]
    return "\n".join(kept)


def extract(pages: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``page_id, url, text, n_chars`` per row of ``pages``."""
    texts = computed(pages.select("page_id", "url", "html"), "html", "text", StringType(),
                     lambda htmls: [main_text(h, threshold) for h in htmls])
    return texts.withColumn("n_chars", F.length("text").cast("long"))

"""HTML main-text extraction by consensus host paths.

Every page is parsed once into its containers (elements that hold blocks). A container's path is the chain
of its ancestors' tags and classes, generalised: digits in classes are dropped, ids are ignored. A page
scores each of its containers by the words in its own paragraphs, less the words in links, and Spark adds
the scores up per host and path. The best path of a host wins: from the widest, the search goes on to the
best narrower one while that keeps 1 / `GAIN` of the score. It never goes below an article or main element,
nor below a container (but for the page's body) that has words of its own beside the containers in it: a
heading or lead there belongs to the article. Each page is then extracted again from the containers on
the winning path; a page without such a container uses its own best one.

Within the chosen container, boilerplate elements (navigation, headers, footers, sidebars, notices,
adverts, forms, comments by readers, scripts, styles) are left out by tag, role and class. Character
references are decoded, white space within a block becomes one space, and non-empty blocks are joined in
page order by one newline.

Votes are summed before their shuffle, so a host with a third of all pages is one row per task. Html is
never shuffled while the winning paths are few enough to broadcast (counted; beyond the bound they are
joined by host, where adaptive execution splits a large host). Parsing is tolerant; nothing is cut off.
Within scripts, styles and the like only their own end tag counts; where it is missing they end at the
next block's tag. Other elements without text of the article (buttons, drawings) count only if they are
closed, and a comment that is not closed ends at the next ">".

Results for odd input: null or empty html gives empty text; a null url, or one without a host, counts as
host ''; null page_ids and repeated rows keep their rows; ties between paths go to the narrower, then
the first by name; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, guarded

GAIN = 1.2
HOSTS = 200_000

#: A tag; one whose quotes do not match up; and the names of all end tags.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)")
LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)")
MARKED = (("<!--", "-->"), ("<![CDATA[", "]]>"), ("<!", ">"), ("<?", ">"))
ENDS = re.compile(r"</([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
SPACE = re.compile(r"\s+")
HOST = re.compile(r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")

#: Fixed element lists of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
HIDDEN = frozenset("noscript template svg math object select button canvas audio video".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
STOP = frozenset(("article", "main"))
CONTAINER = frozenset("article body div main section td blockquote".split())
DROP = frozenset("nav header footer aside form menu dialog head label fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: A new block of the first kind ends an open one of the second.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Words in a class or id that mark boilerplate.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|side-?bar\w*|footer|site-?header|masthead|header|cookies?\w*|consent|gdpr|notice\w*|popup|modal|newsletter|subscri\w+|"
    r"social|share|sharing|related|recommend\w*|comments?|comment-?\w*|replies|disqus|widget\w*|toolbar|pagination|pager|login|signup|search\w*|skip-?link\w*|copyright|legal|disclaimer|alert)(?:$|[\s_-])",
    re.I,
)


#: The next tag of a block, where an unclosed raw element ends.
BLOCK_TAG = re.compile(r"</?(?:" + "|".join(sorted(BLOCK)) + r")(?=[\s/>])", re.I)


def host_of(url: str | None) -> str:
    m = HOST.match(url or "")
    return m[1].lower() if m else ""


class Block:
    __slots__ = ("parts", "path", "linked")

    def __init__(self, path: tuple):
        self.parts: list[str] = []
        self.linked = 0
        self.path = path


def blocks(page: str | None) -> list[Block]:
    """The non-empty blocks of a page outside boilerplate, in page order; path: (key, number) of each open container."""
    out: list[Block] = []
    #: Open elements: tag, whether it hides its content, its container path.
    stack: list[tuple[str, bool, tuple]] = [("", False, ())]
    serial = links = 0
    now = Block(())
    at, page = 0, page or ""
    low = page.lower() if page.isascii() else "".join(c.lower() if c < "\x80" else c for c in page)
    last = {m[1]: m.start() for m in ENDS.finditer(low)}

    def text(s: str) -> None:
        if s and not stack[-1][1]:
            now.parts.append(s)
            if links:
                now.linked += len(s.split())

    def fresh() -> None:
        nonlocal now
        if now.parts and not SPACE.fullmatch("".join(now.parts)):
            out.append(now)
        now = Block(stack[-1][2])

    def close(tag: str) -> None:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k][0] == tag:
                if tag in BLOCK or any(e[0] in BLOCK for e in stack[k:]):
                    del stack[k:]
                    fresh()
                else:
                    del stack[k]
                return

    while at < len(page):
        lt = page.find("<", at)
        if lt < 0:
            text(page[at:])
            break
        text(page[at:lt])
        for opens, ends in MARKED if page[lt + 1 : lt + 2] in ("!", "?") else ():
            if page.startswith(opens, lt) and (end := page.find(ends, lt + len(opens))) >= 0:
                at = end + len(ends)
                break
        else:
            m = TAG.match(page, lt) or LOOSE.match(page, lt)
            if not m:
                text("<")
                at = lt + 1
                continue
            at = m.end()
            tag, attributes = m[2].lower(), m[3]
            if m[1]:
                if tag not in VOID:
                    close(tag)
                links -= tag == "a" and links > 0
            elif tag in VOID:
                if tag == "hr":
                    fresh()
                elif tag == "br" and not stack[-1][1]:
                    now.parts.append(" ")
            elif tag in RAW:
                if not attributes.rstrip().endswith("/"):
                    if last.get(tag, -1) >= at:
                        end = low.find(f"</{tag}", at)
                        while low[end + len(tag) + 2 : end + len(tag) + 3] not in ("", ">", "/", " ", "\t", "\n", "\r", "\f"):
                            end = low.find(f"</{tag}", end + 1)
                            if end < 0:
                                break
                        gt = page.find(">", end) if end >= 0 else -1
                        at = gt + 1 if gt >= 0 else len(page)
                    else:
                        m = BLOCK_TAG.search(page, at)
                        at = m.start() if m else len(page)
            elif tag in HIDDEN:
                if not attributes.rstrip().endswith("/") and last.get(tag, -1) >= at:
                    stack.append((tag, True, stack[-1][2]))
            elif tag == "a":
                links = 1
            elif tag in BLOCK:
                links = 0
                found = {k.lower(): a or b or c for k, a, b, c in ATTRIBUTE.findall(attributes)} if attributes else {}
                marks = f"{found.get('class', '')} {found.get('id', '')}"
                hidden = tag in DROP
                if tag == "header" and any(e[0] in ("article", "main") for e in stack):
                    hidden = False  # an article's own heading
                if tag not in ("html", "body", "article", "main") and (NOISE.search(marks) or found.get("role", "").lower() in ROLES):
                    hidden = True
                if "hidden" in attributes.lower().split() or found.get("aria-hidden", "").lower() == "true" or "display:none" in found.get("style", "").replace(" ", "").lower():
                    hidden = True
                while len(stack) > 1 and stack[-1][0] not in HIDDEN and (stack[-1][0] == "p" or stack[-1][0] in CLOSES.get(tag, ()) or stack[-1][0] not in BLOCK):
                    if stack[-1][0] == "p" or stack[-1][0] in BLOCK or tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                        stack.pop()
                    else:
                        break
                path = stack[-1][2]
                if tag in CONTAINER:
                    serial += 1
                    key = tag + "".join("." + c for c in sorted({re.sub(r"[\d>]+", "", c.lower()) for c in found.get("class", "").split()}) if c)
                    path = (*path, (key, serial))
                stack.append((tag, hidden or stack[-1][1], path))
                fresh()
            else:
                stack.append((tag, stack[-1][1] or tag == "option", stack[-1][2]))
    stack = [("", False, ())]
    fresh()
    return out


def _line(b: Block) -> str:
    return SPACE.sub(" ", _html.unescape("".join(b.parts))).strip()


def _name(path: tuple, depth: int) -> str:
    return ">".join(k for k, _ in path[:depth])


def scores(found: list[Block]) -> dict[str, tuple[float, float]]:
    """Of each generalised path on a page: the words of all blocks within it, less twice those in links; and of the blocks directly in it."""
    out: dict[str, tuple[float, float]] = {}
    for b in found:
        words = sum(len(p.split()) for p in b.parts) - 2 * b.linked
        for depth in range(1, len(b.path) + 1):
            name = _name(b.path, depth)
            whole, direct = out.get(name, (0, 0))
            out[name] = (whole + words, direct + words * (depth == len(b.path)))
    return out


def ends(path: str, direct: float) -> bool:
    """Whether the search for the article stops at a path whose own blocks score `direct`."""
    tag = path.rpartition(">")[2].partition(".")[0]
    return tag in STOP or tag != "body" and direct > 0


def best(score: dict[str, tuple[float, float]]) -> str:
    """The winning path: from the widest, go on to the narrower one while it keeps 1 / GAIN of the score, but not below one that `ends`."""
    now = ""
    top = max((s for s, _ in score.values()), default=0)
    while not now or not ends(now, score[now][1]):
        inner = [(-s, p) for p, (s, _) in score.items() if p.rpartition(">")[0] == now and p != now and s > 0]
        if not inner or -min(inner)[0] * GAIN < top:
            return now
        top, now = -min(inner)[0], min(inner)[1]
    return now


def extract(found: list[Block], winner: str | None) -> str:
    """The text of the blocks on the winning path; by the page's own best path if it has none there."""
    own = scores(found)
    path = winner if winner is not None and (winner == "" or own.get(winner, (0, 0))[0] > 0) else best(own)
    depth = path.count(">") + 1 if path else 0
    lines = (_line(b) for b in found if _name(b.path, depth) == path)
    return "\n".join(x for x in lines if x)


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path): the winning path of every host, by the votes of all its pages."""

    def vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            total: dict[tuple[str, str], tuple[float, float]] = {}
            for url, page in zip(b["url"], b["html"]):
                host = host_of(url)
                for path, (s, d) in scores(blocks(page)).items():
                    whole, direct = total.get((host, path), (0, 0))
                    total[host, path] = (whole + s, direct + d)
            yield pd.DataFrame([(h, p, float(s), float(d)) for (h, p), (s, d) in total.items()], columns=["host", "path", "score", "direct"])

    votes = pages.select("url", "html").mapInPandas(vote, "host string, path string, score double, direct double")
    votes = votes.groupBy("host", "path").agg(F.sum("score").alias("score"), F.sum("direct").alias("direct")).where("score > 0")
    # from the widest path to the narrowest: the best child of each path, then the chain that starts at the root
    votes = votes.withColumn("parent", F.regexp_extract("path", "^(.*)>[^>]*$", 1))
    child = cut(votes.groupBy("host", "parent").agg(F.max_by(F.struct("path", "score", "direct"), F.struct("score", "path")).alias("c")).select("host", "parent", "c.*"))
    tag = F.regexp_extract("a.path", "([^>.]*)[^>]*$", 1)
    stops = tag.isin(*sorted(STOP)) | (tag != "body") & (F.col("a.direct") > 0)
    chain = child.where("parent = ''").select("host", "path", "score", "direct")
    done = []
    while not chain.isEmpty():  # as many rounds as paths are deep
        step = chain.alias("a").join(child.alias("b"), F.expr("a.host = b.host and a.path = b.parent and b.score * {} >= a.score".format(GAIN)) & ~stops, "left")
        step = cut(step.select("a.host", F.col("a.path").alias("old"), "b.path", "b.score", "b.direct"))
        done.append(step.where("path is null").select("host", F.col("old").alias("path")))
        chain = step.where("path is not null").select("host", "path", "score", "direct")
    out = done[0] if done else chain.select("host", "path")
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of `pages` (page_id, url, html)."""
    p = pages.select("page_id", "url", "html")
    winners = cut(host_paths(p))
    kind = p.schema["page_id"].dataType.simpleString()
    lowered = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), "^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1))
    joined = p.withColumn("host", lowered).join(guarded(winners, HOSTS), "host", "left").select("page_id", "url", "html", "path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = [extract(blocks(h), w) for h, w in zip(b["html"], b["path"])]
            yield pd.DataFrame({"page_id": b["page_id"], "url": b["url"], "text": texts, "n_chars": [len(t) for t in texts]})

    return joined.mapInPandas(run, f"page_id {kind}, url string, text string, n_chars bigint")

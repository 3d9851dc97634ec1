"""Main text of web pages by tree scoring.

The page becomes a light tree. Elements that never hold article text (navigation,
footers, asides, scripts, hidden parts, ..) are cut at once. Every paragraph then earns
points for its length and its commas and passes them to its ancestors, halved at each
step up; a container's points are discounted by its link density.

Names only vote. An element whose class or id names boilerplate (words of a name are split
at signs, at capitals and at common endings; a word after ``no``, ``has`` or ``with`` says
what the page has, not what the element is) and a form go, unless the tree speaks
against it: it holds the article or main element, or most of the page's points. Words that also
occur in articles (``related``, ``social``, ..) beside a word of their own, as in
``related-work``, vote only against parts without points or with many links. Blocks
of reader comments stay out whatever their points, unless the main element is in them.

The article is the article or main element around the best container, whole. Without one
it is the container with its ancestors as far up as they add no link-dense block, and with
all siblings there that aren't link-dense. Article elements beside the article belong to it
unless they are teasers: dense with links, or linking on with few points of their own.

Text is taken block by block in page order: character references are decoded,
white space inside a block becomes one space, and blocks are joined by a space.

The reading is one linear pass with a regular expression; missing end tags,
stray end tags and pages cut in the middle of a tag are all accepted.

Defined results: null, empty and tag-only pages give an empty text. Repeated
rows each give their own row. An empty table gives no rows; extra columns are
not read.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

from pyspark.sql import DataFrame

from roadrisk.llm.common import arrow_map

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z))*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"\b(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template svg math object select".split())
#: Of these the content is text up to their own end tag; the other raw elements hold markup.
RAW_TEXT = frozenset("script style textarea title noscript iframe".split())
RAW_END = {t: re.compile(rf"</{t}(?=[\s/>]|\Z)", re.I | re.A) for t in RAW_TEXT}
FOREIGN = frozenset("svg math".split())
CUT = RAW | frozenset("head nav footer aside button dialog menu".split())
BLOCK = frozenset("""address article aside blockquote body br center dd details dialog div dl dt fieldset figcaption figure
footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul""".split())
PARAGRAPH = frozenset("p pre td li dd blockquote h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCK - {"br"}
#: An open element of the first kind ends when one of the second begins.
SELF_CLOSING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
SCOPE = frozenset("table ul ol dl div section article main body html".split())

#: Words that name boilerplate by themselves; of these COMMENTS name what readers wrote.
COMMENTS = frozenset("comment comments disqus".split())
BOILERPLATE = COMMENTS | frozenset("""ad ads advert adverts advertisement advertising adsense banner banners sponsor sponsored promo promotion nav
navbar menu breadcrumb breadcrumbs cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login pager pagination
toolbar outbrain taboola""".split())
#: Words that do so alone or beside NEUTRAL words; beside others they may belong to an article.
ANSWERS = frozenset("responses replies respond reactions".split())
MAYBE = ANSWERS | frozenset("navigation sidebar rail aside footer notice notices share sharing social related recommended widget skip".split())
NEUTRAL = frozenset("""a an the and of by my our this all more other top bottom left right center inner outer first last main primary secondary
area bar block blocks body box button buttons card cards col column container content contents feed form frame grid group head header heading
holder icon icons inline item items label link links list lists media module modules news panel post posts article articles story stories
row section site page segment slot stream text thread title tray unit user users view wrap wrapper zone global fixed sticky mobile desktop
small large js col lg md sm xs""".split())
DENIES = frozenset("no not non has have having with without hide hides show shows enable enabled disable disabled open closed".split())
ENDINGS = tuple(sorted(NEUTRAL | {"s", "er", "wrap", "ing"}, key=len, reverse=True))
PAGE_HEADER = frozenset("header masthead topbar".split())
ROLES = frozenset("navigation banner contentinfo complementary dialog alert alertdialog search form menu menubar".split())
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
#: How an element's names vote: against text of any kind, against all but the main element, or with doubt.
CLEAR, READERS, DOUBT = 1, 2, 3

LEAST_CHARS = 25        # of a paragraph to earn points
ARTICLE_BONUS = 25.0
LINK_DENSE = 0.5        # share of linked characters


class Node:
    __slots__ = ("tag", "up", "kids", "score", "chars", "linked", "cut", "vote", "points", "holds")

    def __init__(self, tag: str, up: Node | None, cut: bool, vote: int = 0):
        self.tag, self.up, self.kids = tag, up, []
        self.score, self.chars, self.linked = 0.0, 0, 0
        self.cut = cut
        self.vote = vote      # of its names against it
        self.points = 0.0     # of all paragraphs below
        self.holds = 0        # 1: an article element that isn't voted against, 2: a main element


def name_words(name: str) -> list[str]:
    """The words of one class name or id: parts, with joined endings taken off listed words."""
    out = []
    for part in PARTS.findall(name):
        part = part.lower()
        if part not in BOILERPLATE and part not in MAYBE and part not in NEUTRAL:
            for end in ENDINGS:
                start = part[:-len(end)]
                if part.endswith(end) and len(start) > 2 and (start in BOILERPLATE or start in MAYBE):
                    part = start
                    break
        out.append(part)
    return out


def name_vote(name: str) -> int:
    words = name_words(name)
    told = [w for i, w in enumerate(words) if not any(x in DENIES for x in words[:i])]
    if any(w in COMMENTS for w in told):
        return READERS
    if any(w in BOILERPLATE for w in told):
        return CLEAR
    if any(w in MAYBE for w in told):
        if any(w not in MAYBE and w not in NEUTRAL for w in told):
            return DOUBT
        return READERS if any(w in ANSWERS for w in told) else CLEAR
    return 0


def is_cut(tag: str, attributes: str, inside_article: bool) -> bool:
    """Whether an element goes whatever it holds."""
    if tag in CUT or tag == "header" and not inside_article:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "role" and value in ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name in ("class", "id") and not inside_article and any(set(name_words(n)) & PAGE_HEADER for n in value.split()):
            return True
    return False


def vote(tag: str, attributes: str) -> int:
    """How an element's names vote against it."""
    if tag in ("html", "body", "main") or not attributes:
        return CLEAR if tag == "form" else 0
    votes = [name_vote(n) for m in ATTRIBUTE.finditer(attributes) if m[1].lower() in ("class", "id")
             for n in (m[2] or m[3] or m[4] or "").split()]
    if tag == "article":  # only what readers wrote: each of its names says so
        return READERS if votes and all(v == READERS for v in votes) else 0
    for kind in (READERS, CLEAR, DOUBT):
        if kind in votes:
            return kind
    return CLEAR if tag == "form" else 0


def parse(html: str) -> Node:
    """The tree without what is cut. Kids are nodes and texts."""
    root = node = Node("", None, False)
    at, articles = 0, 0
    open_: Counter[str] = Counter()
    raw = ""          # the raw element with markup that is open, if any
    cut = 0           # depth below a cut element
    while m := TOKEN.search(html, at):
        tag = (m[2] or "").lower()
        if m.start() > at and not cut and not raw:
            node.kids.append(html[at:m.start()])
        at = m.end()
        if tag in RAW_TEXT and not m[1] and raw not in FOREIGN:
            if not m[3].endswith("/"):  # the next token is its end tag, which closes nothing
                end = RAW_END[tag].search(html, at)
                at = end.start() if end else len(html)
            continue
        if raw:
            if m[1] and tag == raw:
                raw = ""
            continue
        if not tag:
            continue
        if m[1]:  # an end tag closes the nearest such element, if one is open
            if not open_[tag]:
                continue
            n = node
            while n.tag != tag:
                n = n.up
            while True:
                open_[node.tag] -= 1
                cut -= node.cut
                articles -= node.tag in ("article", "main")
                closed, node = node, node.up
                if closed is n:
                    break
            continue
        if tag in CLOSES_P and open_["p"] or tag in SELF_CLOSING:
            n = node
            while n.up is not None and n.tag not in SCOPE:
                if n.tag == "p" and tag in CLOSES_P or tag in SELF_CLOSING.get(n.tag, ()):
                    while node is not n.up:
                        open_[node.tag] -= 1
                        cut -= node.cut
                        node = node.up
                    break
                n = n.up
        if tag in RAW:
            if not m[3].endswith("/"):
                raw = tag
            continue
        if tag in VOID:
            if not cut:
                node.kids.append(Node(tag, node, False))
            continue
        new = Node(tag, node, is_cut(tag, m[3], articles > 0))
        if not cut:
            if not new.cut:
                new.vote = vote(tag, m[3])
                node.kids.append(new)
            elif tag in BLOCK:
                node.kids.append(Node("br", node, False))  # what goes still parts the texts around it
        articles += tag in ("article", "main")
        cut += new.cut
        open_[tag] += 1
        node = new
    if not raw and not cut and at < len(html):
        node.kids.append(html[at:])
    return root


def walk(root: Node):
    """Nodes in page order, and each again when it ends; without recursion."""
    stack = [(root, iter(root.kids))]
    yield root, True
    while stack:
        node, kids = stack[-1]
        for kid in kids:
            if isinstance(kid, str):
                yield kid, True
            else:
                yield kid, True
                stack.append((kid, iter(kid.kids)))
                break
        else:
            stack.pop()
            yield node, False


def texts(root: Node) -> list[str]:
    """Blocks of text below root, in page order."""
    blocks, now = [], []

    def end():
        if now:
            block = " ".join("".join(now).split())
            if block:
                blocks.append(block)
            now.clear()

    for item, _ in walk(root):
        if isinstance(item, str):
            now.append(unescape(item))
        elif item.tag in BLOCK:
            end()
    end()
    return blocks


def measure(root: Node) -> None:
    """Characters and linked characters of every node, and the points of containers."""
    links, path = 0, []
    for item, opens in walk(root):
        if isinstance(item, str):
            n = len(item.strip())
            path[-1].chars += n
            path[-1].linked += n if links else 0
        elif opens:
            path.append(item)
            links += item.tag == "a"
        else:
            path.pop()
            links -= item.tag == "a"
            if path:
                path[-1].chars += item.chars
                path[-1].linked += item.linked
                if item.chars:
                    own = 2 if item.tag == "main" else item.tag == "article" and not item.vote
                    path[-1].holds = max(path[-1].holds, item.holds, int(own))
            own_text = item.tag not in PARAGRAPH and any(isinstance(k, str) and len(k.strip()) >= LEAST_CHARS for k in item.kids)
            if item.chars >= LEAST_CHARS and (item.tag in PARAGRAPH or own_text and item.tag in BLOCK):
                text = "".join(k for k in item.kids if isinstance(k, str))
                commas = text.count(",") + text.count("、") + text.count("，")
                points = (1 + commas + min(item.chars / 100, 3)) * (1 - item.linked / item.chars)
                item.points += points
                if own_text:
                    item.score += points
                share, up = 1.0, item.up
                while up is not None and share > 0.1:
                    if up.tag in BLOCK:
                        up.score += points * share
                        share /= 2
                    up = up.up
            if path:
                path[-1].points += item.points


def outvoted(n: Node, total: float) -> bool:
    """Whether the tree speaks against the vote of an element's names."""
    if n.holds == 2:
        return True
    if n.vote == READERS:
        return False
    if n.holds or 2 * n.points > total and not link_dense([n]):
        return True
    return n.vote == DOUBT and n.points > 0 and not link_dense([n])


TEASER = 0.25    # share of the article's points below which an article element that links on is a teaser


def teaser(n: Node, article: Node) -> bool:
    """Whether an article element beside the article leads on to another page."""
    return link_dense([n]) or n.linked > 0 and n.points < TEASER * article.points


def judge(root: Node) -> bool:
    """Cut the elements that are voted out and the teasers beside an article, from the top down.
    Returns whether anything was cut."""
    total, changed, todo = root.points, False, [root]
    while todo:
        node = todo.pop()
        kept = []
        articles = [k for k in node.kids if isinstance(k, Node) and k.tag == "article" and k.chars and not k.vote]
        lead = max(articles, key=lambda a: a.points, default=None)
        teasers = {id(a) for a in articles if a is not lead and teaser(a, lead)}
        for kid in node.kids:
            if isinstance(kid, Node) and (kid.vote and not outvoted(kid, total) or id(kid) in teasers):
                changed = True
                if kid.tag in BLOCK:
                    kept.append(Node("br", node, False))
                continue
            kept.append(kid)
            if isinstance(kid, Node):
                todo.append(kid)
        node.kids = kept
    return changed


def forget(root: Node) -> None:
    for item, opens in walk(root):
        if isinstance(item, Node) and opens:
            item.score, item.points, item.chars, item.linked = 0.0, 0.0, 0, 0


def density(n: Node) -> float:
    return n.linked / n.chars if n.chars else 0.0


def runs(kids: list, path: Node) -> list[list]:
    """The kids, with neighbouring texts and inline elements together; path is a block."""
    out, inline = [], False
    for k in kids:
        block = k is path or isinstance(k, Node) and any(isinstance(x, Node) and x.tag in BLOCK for x, _ in walk(k))
        if block or not inline:
            out.append([])
        out[-1].append(k)
        inline = not block
    return out


def link_dense(run: list) -> bool:
    chars = sum(k.chars if isinstance(k, Node) else len(k.strip()) for k in run)
    return chars > 0 and sum(k.linked for k in run if isinstance(k, Node)) >= LINK_DENSE * chars


def whole_article(best: Node) -> list[Node]:
    """What to keep: the article around the best container.

    That is all of the article or main element that it is in. From an article in a
    main element (up to that), or from a container outside of both, it climbs while
    that adds no link-dense block, and then keeps all siblings but such blocks."""
    above, n = [], best
    while n is not None:
        above.append(n)
        n = n.up
    article = next((n for n in reversed(above) if n.tag == "article"), None)
    main = next((n for n in above[above.index(article) if article else 0:] if n.tag == "main"), None)
    if article and not main and article.up is not None:
        return [k for k in article.up.kids if k is article or isinstance(k, Node) and k.tag == "article" and k.chars]
    now = article or main or best
    while now is not main and now.up is not None:
        around = runs(now.up.kids, now)
        if any(link_dense(r) for r in around if r[0] is not now):
            kept = Node("", None, False)
            for r in around:  # what goes still parts the text before it from the text after it
                stays = r[0] is now or not link_dense(r)
                kept.kids += r if stays else [Node("br", None, False)]
            return [kept]
        now = now.up
    return [now]


def main_text(html: str | None) -> str:
    root = parse(html or "")
    measure(root)
    if judge(root):
        forget(root)
        measure(root)
    best, top = None, 0.0
    for item, opens in walk(root):
        if isinstance(item, Node) and opens and item.chars and item.tag in BLOCK | {""}:
            score = item.score * (1 - density(item)) + ARTICLE_BONUS * (item.tag in ("article", "main"))
            if best is None or score > top:
                best, top = item, score
    return " ".join(b for n in whole_article(best or root) for b in texts(n))


def page_texts(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages."""
    def make():
        def work(batch):
            out = [main_text(h) for h in batch.column("html").to_pylist()]
            yield {"page_id": batch.column("page_id"), "url": batch.column("url"), "text": out, "n_chars": [len(t) for t in out]}
        return work

    kind = {f.name: f.dataType.simpleString() for f in pages.schema}
    return arrow_map(pages.select("page_id", "url", "html"),
                     f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long", make)

"""Main text of web pages by tree scoring.

Each block of text passes points for its length and its commas, discounted by its share of link
text, to the element that holds it, half of them to the next one out, a quarter further on. The
best container (its score discounted by its own link share) is found. If it lies in an article (or else
a main element, or else an element named as an article), all of that is kept; otherwise the
container, with those siblings that score enough or are plain prose, and the headings beside it. Menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments never count and
are never kept; what is so only by its name, and forms, count as such unless they hold the page's
article (on a page without article or main element: more than half of its text). One such word among others in the class
of a paragraph of prose, and a set of fields without a field, say nothing. Of several articles beside each other the best is
the page's; the others are kept only if they lie in it.

Defined results: a null, empty or textless page gives ''; an empty table gives no rows. Broken markup is read as browsers do where
it matters: unclosed elements end with their parent, an open paragraph ends at the next block, an
unfinished tag or comment at the end of the page is dropped, a stray ``<`` is text. Pages of any
length are read whole and depth is not limited. Repeated rows give repeated results. Ties go to the
container that begins first. Columns other than those named or carried are not looked at.
"""

from __future__ import annotations

import html as entities
import re

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import map_arrow, rows_of

#: How HTML's elements behave.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split()
)
CLOSES_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split())
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "tbody": {"tr", "td", "th", "thead", "tbody"}, "thead": set(), "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "tbody": {"table"}, "tfoot": {"table"}}
#: Elements, roles and names of what is not the article.
BOILERPLATE_TAGS = set("head nav footer aside button select dialog menu svg canvas audio video object map datalist search".split())
BOILERPLATE_ROLES = set("navigation banner complementary contentinfo search dialog alert alertdialog menu menubar form".split())
COMMENT_NAMES = set("comment comments commentlist disqus respond replies reply feedback".split())
ADVERT_NAMES = set("ad ads adv advert adverts advertisement advertisements adsense promo sponsor sponsored sponsors cookie cookies consent gdpr".split())
BOILERPLATE_NAMES = COMMENT_NAMES | ADVERT_NAMES | set(
    "banner banners promotion nav navbar navigation menu menus breadcrumb breadcrumbs"
    " sidebar sidebars aside footer foot masthead header topbar toolbar notice notices disclaimer popup modal overlay newsletter subscribe subscription signup login"
    " share sharing social related recommended pagination pager widget widgets skip hidden".split()
)
#: A name of several parts is boilerplate by its last part, or by its first one before one of these.
HOLDERS = set("area bar block box button buttons container content form header inner items left link links list module panel posts right row section stories text thread top unit widget wrap wrapper".split())
#: Parts that say what an element's inside has or lacks.
SAYS_HAS = set("has have no not non with without is in hide show no1 sans".split())
ARTICLE_NAMES = set("article content main post entry story text body page".split())
#: Names of elements that are kept whole around the best container.
WHOLE_NAMES = set("article articlebody article-body article-content articlecontent content main-content maincontent entry entry-content entrycontent post post-body post-content postbody postcontent story story-body storybody".split())
PROSE = {"p", "pre", "blockquote", "li", "dd", "dt", "td", "th", "h1", "h2", "h3", "h4", "h5", "h6", "figcaption", "summary"}
HEADINGS = {"h1", "h2", "h3"}
#: How surely an element is not the article, from not at all on.
SUSPICIONS = ("", "weak", "fields", "form", "name", "advert", "comment")
SENTENCE_ENDS = (".", "!", "?", ":", "…", "»", '"', "”")

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*'|["'])*?)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style|type)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
NAME_PARTS = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+(?![a-z])")


class Node:
    __slots__ = ("tag", "parent", "dropped", "suspect", "favoured", "whole", "score", "chars", "links", "kept", "prose", "fields")

    def __init__(self, tag, parent, dropped, suspect="", favoured=False, whole=0):
        self.tag, self.parent, self.dropped, self.suspect, self.favoured, self.whole = tag, parent, dropped, suspect, favoured, whole
        self.score, self.chars, self.links, self.kept, self.prose, self.fields = 0.0, 0, 0, False, False, False

    def worth(self) -> float:
        density = self.links / self.chars if self.chars else 0.0
        return self.score * (1 - density) * (1.25 if self.favoured else 1.0)


def _named(token: str) -> str:
    """'comment', 'advert' or 'name' if a word of class or id names what is not the article, else ''."""
    parts = [x.lower() for x in NAME_PARTS.findall(token)]
    if not parts or parts[0] in SAYS_HAS:
        return ""
    hit = parts[-1] if parts[-1] in BOILERPLATE_NAMES else parts[0] if parts[0] in BOILERPLATE_NAMES and parts[-1] in HOLDERS else ""
    return "comment" if hit in COMMENT_NAMES else "advert" if hit in ADVERT_NAMES else "name" if hit else ""


def _traits(tag: str, attrs: str, inside_article: bool) -> tuple[bool, str, bool, int]:
    """Whether an element is boilerplate, how it is suspected to be, whether it is named like an article,
    and how surely it is to be kept whole (3: article, 2: main, 1: by its name)."""
    if tag in BOILERPLATE_TAGS or (tag == "header" and not inside_article):
        return True, "", False, 0
    suspect = {"form": "form", "fieldset": "fields"}.get(tag, "")
    favoured = tag in ("article", "main")
    whole = {"article": 3, "main": 2}.get(tag, 0)
    if attrs and not attrs.isspace():
        for m in ATTRIBUTE.finditer(attrs):
            key, value = m[1].lower(), (m[2] or "").strip("\"'")
            if key in ("class", "id"):
                tokens = value.split()
                if tokens and tag not in ("html", "body", "article", "main"):
                    named = [_named(token) for token in tokens]
                    most = max(named, key=SUSPICIONS.index)
                    if most == "name" and "" in named and (tag in PROSE or tag in INLINE):
                        most = "weak"
                    suspect = max(suspect, most, key=SUSPICIONS.index)
                for token in tokens:
                    favoured |= token.lower() in ARTICLE_NAMES or any(x.lower() in ARTICLE_NAMES for x in NAME_PARTS.findall(token))
                    if token.lower() in WHOLE_NAMES and tag not in ("html", "body"):
                        whole = max(whole, 1)
            elif key == "role" and value.lower() in BOILERPLATE_ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
                return True, "", False, 0
            elif key == "role" and value.lower() in ("main", "article"):
                favoured, whole = True, max(whole, 2)
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True, "", False, 0
    return False, suspect, favoured, whole


def main_text(page: str | None) -> str:
    """The article's blocks, one to a line."""
    if not page:
        return ""
    root = Node("#root", None, False)
    nodes, blocks = [root], []  # blocks: (element, text, characters in links)
    stack: list[Node] = [root]  # open block elements
    inline: list[tuple[str, bool]] = []  # open inline elements: name, whether it drops its text
    links = muted = articles = 0
    buffer: list[tuple[str, bool]] = []

    def flush():
        if buffer:
            text = " ".join("".join(x for x, _ in buffer).split())
            if text:
                linked = sum(len(" ".join(x.split())) for x, in_link in buffer if in_link)
                blocks.append((stack[-1], text, min(linked, len(text))))
            buffer.clear()

    def close_to(k: int):
        nonlocal articles, links, muted
        flush()
        for node in stack[k:]:
            articles -= node.tag in ("article", "main")
        del stack[k:]
        if inline:  # formatting does not outlive its block
            inline.clear()
            links = muted = 0

    at, n = 0, len(page)
    while at < n:
        m = TOKEN.search(page, at)
        text = page[at : m.start()] if m else page[at:]
        if text and not muted and not stack[-1].dropped:
            buffer.append((entities.unescape(text) if "&" in text else text, links > 0))
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if not page.startswith(">", at - 1):
            break  # the page ends inside a tag
        if m[1]:
            if tag in INLINE:
                for k in range(len(inline) - 1, -1, -1):
                    if inline[k][0] == tag:
                        for name, drops in inline[k:]:
                            links -= name == "a"
                            muted -= drops
                        del inline[k:]
                        break
            else:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag == tag:
                        close_to(k)
                        break
                    if tag == "p" and stack[k].tag in CLOSES_P or stack[k].tag == "table" and tag in ("div", "p"):
                        flush()
                        break
            continue
        if tag in ("select", "textarea", "button") or tag == "input" and not re.search(r"type\s*=\s*[\"']?hidden", m[3], re.I):
            for node in stack:
                node.fields = True
        if tag in RAW:
            flush_at = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
            at = flush_at.end() if flush_at else n
            continue
        if tag == "br":
            buffer.append((" ", False))
            continue
        if tag in INLINE:
            if tag not in VOID:
                hard, suspect, *_ = _traits(tag, m[3], articles > 0)
                drops = hard or suspect not in ("", "weak")
                inline.append((tag, drops))
                links += tag == "a"
                muted += drops
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag == "p":
                    close_to(k)
                    break
                if stack[k].tag in CLOSES_P or stack[k].tag in ("td", "th", "li", "dd"):
                    break
        if ends := ENDED_BY.get(tag):
            stop, cut = SCOPE.get(tag, ()), 0
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].tag in stop:
                    break
                if stack[k].tag in ends:
                    cut = k
            if cut:
                close_to(cut)
        flush()
        if tag in VOID:
            continue
        if tag in ("html", "body") and any(x.tag == tag for x in stack):
            continue
        if tag == "body":  # an open head ends here
            close_to(next((k for k in range(1, len(stack)) if stack[k].tag == "head"), len(stack)))
        dropped, suspect, favoured, whole = _traits(tag, m[3], articles > 0)
        node = Node(tag, stack[-1], stack[-1].dropped or dropped, suspect, favoured, whole)
        nodes.append(node)
        stack.append(node)
        articles += tag in ("article", "main")
    flush()

    for owner, text, linked in blocks:
        owner.chars += len(text)
        owner.links += linked
        owner.prose |= len(text) > 80 or text.endswith(SENTENCE_ENDS)
    for node in reversed(nodes):  # what an element holds, before suspects go
        if node.parent:
            node.parent.chars += node.chars
            node.parent.links += node.links
            if node.tag in ("article", "main") or node.score:  # score: whether an article lies below
                node.parent.score = 1.0
    articles = root.score > 0
    for node in nodes:
        if node.suspect and not node.dropped:
            holds = node.score > 0 if articles else 2 * node.chars > root.chars
            text = 4 * node.links <= node.chars and (node.prose if node.suspect == "weak" else node.suspect == "fields" and not node.fields)
            node.dropped = node.suspect == "comment" or not holds and not text
        node.dropped |= node.parent is not None and node.parent.dropped
    if blocks and all(owner.dropped for owner, _, _ in blocks):  # nothing is left: the largest suspect was the article
        for node in nodes:
            node.dropped = False
    blocks = [x for x in blocks if not x[0].dropped]
    for node in nodes:
        node.score, node.chars, node.links = 0.0, 0, 0

    for owner, text, linked in blocks:
        owner.chars += len(text)
        owner.links += linked
        n_chars = len(text)
        points = (min(n_chars / 25, 1) + text.count(",") + min(n_chars / 100, 3)) * (1 - linked / n_chars)
        node = owner.parent if owner.tag in PROSE and owner.parent else owner
        while node is not None and points > 1e-3:
            node.score += points
            node, points = node.parent, points / 2
    if not blocks:
        return ""
    for node in reversed(nodes):
        if node.parent:
            node.parent.chars += node.chars
            node.parent.links += node.links
    best = max(nodes, key=Node.worth)
    if best.worth() <= 0:  # links alone: the article, or main element, with the most text, if there is one
        best = max(nodes, key=lambda x: (x.whole, x.chars) if x.whole >= 2 and x.chars else (0, 0))
        if best.whole < 2 or not best.chars:
            return ""
    outer, node = None, best
    while node is not None:  # the outermost of the surest kind
        if node.whole and (outer is None or node.whole >= outer.whole):
            outer = node
        node = node.parent
    if outer is not None:
        outer.kept = True
        menus = set() if outer.whole == 3 else {x for x in nodes if x.parent is outer and x is not best and x.chars and x.links > 0.6 * x.chars}
        for node in nodes:
            node.kept |= node.parent is not None and node.parent.kept and node not in menus
        return "\n".join(text for owner, text, _ in blocks if owner.kept)
    best.kept = True
    if best.parent is not None:
        enough = max(10.0, 0.2 * best.worth())
        own = {}
        for owner, text, linked in blocks:
            if owner.parent is best.parent and owner is not best:
                own.setdefault(owner, []).append((text, linked))
        for node in nodes:
            if node.parent is best.parent and node is not best and not node.dropped:
                if node.worth() >= enough or node.tag in HEADINGS:
                    node.kept = True
                elif node.tag in PROSE and node in own:
                    text, linked = " ".join(t for t, _ in own[node]), sum(k for _, k in own[node])
                    node.kept = len(text) > 80 and linked / len(text) < 0.25 or not linked
                elif node.chars and 4 * node.links <= node.chars:  # lists, notes and tables beside the container
                    node.kept = True
    for node in nodes:
        node.kept |= node.parent is not None and node.parent.kept
    return "\n".join(text for owner, text, _ in blocks if owner.kept)


def extract_main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", carry: list[str] | None = None) -> DataFrame:
    """(id, text, carry): the main text of each page."""

    def f(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([pa.array([main_text(x) for x in b.column(1).to_pylist()], pa.string())], names=["main"])

    return map_arrow(rows_of(pages, id_col, html_col, carry), lambda: f, "main string").withColumnsRenamed({"id": id_col, "main": "text"})

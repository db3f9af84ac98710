"""Main text of web pages by consensus host paths.

Every page's containers are scored; the paths of good ones, as generalised tags and classes, get votes that Spark sums
up by host; each page is then extracted again from the path among its own that its host favours most.
"""

import bisect
import html as _html
import re
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, rows_at_most, ship

#: Hosts whose winning paths are broadcast, at most; beyond it they are joined by a shuffle.
BROADCAST_HOSTS = 50_000
#: Winning paths that a host keeps.
PATHS = 8

# Element names by their role in HTML.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr math mi mn mo ms mtext mrow msup msub msubsup mfrac msqrt mroot mover munder mstyle semantics".split())
_DROP = frozenset("nav footer aside form script style noscript template iframe svg canvas button select option textarea embed head title dialog menu audio video map annotation annotation-xml input".split())
_CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
_SAME = {"li": ("li", {"ul", "ol", "menu"}), "dt": ("dt dd", {"dl"}), "dd": ("dt dd", {"dl"}), "tr": ("tr td th", {"table"}), "td": ("td th", {"tr", "table"}), "th": ("td th", {"tr", "table"}), "option": ("option", {"select"})}
_CONTAINER = frozenset("article main section div td body blockquote".split())
_BAD = frozenset(
    "ad ads advert adverts advertisement advertising adsense adslot banner sponsor sponsored promo promotion promoted sidebar side widget widgets related recommend recommended recommendations "
    "nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager footer foot masthead topbar toolbar skip share sharing social subscribe subscription newsletter signup login cookie cookies consent gdpr "
    "notice notices alert popup modal overlay disclaimer comment comments commentlist disqus respond reply replies discussion form search tags taglist hidden complementary contentinfo dialog tracking legal copyright "
    "topnav sidenav subnav mainnav mainmenu submenu sitemap adbox adunit adwrapper adcontainer addthis outbrain taboola sharebar sharedaddy".split()
)
_GOOD = frozenset("article content post entry story main body text hentry".split())
#: Words that may stand beside one of _BAD in a class without changing what it says.
_BESIDE = _GOOD | frozenset(
    "box block slot wrap wrapper container inner outer area section list item items unit bar col column group panel module region zone holder top bottom left right site page pages posts articles link links "
    "button buttons icon icons title heading header primary secondary global local reader user cta inline card row grid stack".split()
)
#: Elements that are text of an article unless a class of _HARD words says otherwise.
_CONTENT = frozenset("blockquote pre figure table tbody tr td th code h1 h2 h3".split())
_HARD = frozenset("ad ads advert advertisement sponsored comment comments share related".split())

#: Words of _BAD that also name sections of an article: inside one, an element of such words alone stays if it is prose.
_SOFT = frozenset("discussion legal copyright notice notices alert disclaimer reply related recommended recommendations recommend side tags".split())
#: Characters outside links that make prose without a paragraph or heading, at least.
PROSE = 60

_NAME = re.compile(r"/?([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r">|=\s*[\"']")
_ATTR = re.compile(r"""(?:^|[\s"'/])(class|id|role|hidden|aria-hidden|style)(?=[\s=/]|$)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""", re.I)
_ENDS = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I | re.A) for tag in _RAW}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


class _Node:
    """An element: its generalised path as a hash, whether it is left out (bad), only for its class (doubtful), only for _SOFT
    words (soft), its parts (text and elements), the nearest container (itself or above), what it stands in (2: an article
    element, 1: a main element); heading and article: whether one stands in it; mass and links: characters in it outside
    what is left out, outside and inside links."""

    __slots__ = ("tag", "path", "parts", "parent", "bad", "good", "doubtful", "soft", "within", "box", "heading", "article", "mass", "links")

    def __init__(self, tag, path, parent, bad, good, doubtful=False, soft=False):
        self.tag, self.path, self.parent, self.bad, self.good, self.doubtful, self.soft, self.parts = tag, path, parent, bad, good, doubtful, soft, []
        self.within = max(parent.within, 2 if parent.tag == "article" else parent.tag == "main") if parent else 0
        self.box = self if tag in _CONTAINER else parent.box if parent else None
        self.heading = self.article = False
        self.mass = self.links = 0


def _says_bad(value: str, tag: str) -> tuple[bool, bool]:
    """Whether one of a class's (or id's) names says that the element is not the article ("ad-slot", not "social-history"),
    and whether one does by more than _SOFT words."""
    says = hard = False
    for name in value.split():
        words = [w.lower() for w in _WORDS.findall(name)]
        bad = [w for w in words if w in _BAD]
        if bad and all(w in _BAD or w in _BESIDE for w in words) and (tag not in _CONTENT or any(w in _HARD for w in bad)):
            says, hard = True, hard or any(w not in _SOFT for w in bad)
    return says, hard


def _names(attrs: str, tag: str) -> tuple[bool, bool, bool, str, bool]:
    """Whether class, id or role say bad, bad beyond _SOFT words, and good; the generalised classes (digits out); whether the
    element is hidden."""
    bad, hard, good, cls, hidden = False, False, False, "", False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), _html.unescape(m[2] or m[3] or m[4] or "")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            hidden = True
        elif name in ("class", "id", "role"):
            says, more = _says_bad(value, tag)
            bad, hard = bad or says, hard or more
            good = good or any(w.lower() in _GOOD for w in _WORDS.findall(value))
            if name == "class":
                cls = ".".join(sorted({re.sub(r"\d+", "", c) for c in value.split()} - {""})[:3])
    return bad, hard, good, cls, hidden


def _step(path: int, step: str) -> int:
    return ((path * 0x9E3779B97F4A7C15 + zlib.crc32(step.encode()) + 1) ^ path >> 29) & (1 << 63) - 1


def _tag_end(html: str, at: int, last: dict[str, int]) -> int:
    """The place of the > that ends a tag whose attributes start at `at`; -1 if none does. A quote opens a value only behind
    an equals sign, as HTML has it, and only if something closes it; any other quote is an ordinary character.

    last: the last place of each quote and of >. What is looked at lies within the tag, so all tags take linear time."""
    i = at
    while m := _STOP.search(html, i):
        if m[0] == ">":
            return m.start()
        quote = m[0][-1]
        i = html.find(quote, m.end()) + 1 if m.end() <= last[quote] else m.end()
    return -1


def parse(html: str) -> _Node:
    """A tree of elements whose parts are text and elements. Tolerates unclosed, misnested and stray tags.

    Time and memory are in proportion to the page, however deep it nests: open elements are looked up by name."""
    root = _Node("#", 0, None, False, False)
    stack, nodes, blocks, opens = [root], [root], [0], {"#": [0]}  # blocks: places in the stack that are not inline
    last, at, text = {c: html.rfind(c) for c in ">\"'"}, 0, 0

    def close(depth):
        while len(stack) > depth:
            opens[stack.pop().tag].pop()
        while blocks[-1] >= depth:
            blocks.pop()

    def up_to(names) -> int:
        return max((opens[n][-1] for n in names if opens.get(n)), default=0)

    while (i := html.find("<", at)) >= 0:
        at = i + 1
        m = _NAME.match(html, at)
        if m is None and html[at : at + 1] not in ("!", "?", "/"):
            continue  # a mere <
        if text < i:
            stack[-1].parts.append(html[text:i])
        if m is None:
            if html.startswith("!--", at):
                end = html.find("-->", at + 3)
                at = text = len(html) if end < 0 else end + 3
            elif html.startswith("![CDATA[", at):
                end = html.find("]]>", at)
                stack[-1].parts.append(_html.escape(html[at + 8 : end if end >= 0 else len(html)]))
                at = text = len(html) if end < 0 else end + 3
            else:
                end = html.find(">", at)
                at = text = len(html) if end < 0 else end + 1
            continue
        end = _tag_end(html, m.end(), last)
        if end < 0:  # nothing but an unfinished tag is left
            at = text = len(html)
            break
        attrs, tag = html[m.end() : end], m[1].lower()
        at = text = end + 1
        if html[i + 1] == "/":
            where = opens.get(tag)
            if where and where[-1] and (tag not in _INLINE or where[-1] > blocks[-1]):
                close(where[-1])
            elif tag in ("br", "p") and not where:
                stack[-1].parts.append(_Node("br", 0, stack[-1], False, False))
            continue
        if tag in _CLOSES_P and stack[blocks[-1]].tag == "p":
            close(blocks[-1])
        if tag in _SAME:
            ends, stop = _SAME[tag]
            limit = up_to(stop)
            inner = [w for n in ends.split() if opens.get(n) for w in ([opens[n][bisect.bisect_right(opens[n], limit)]] if tag == "tr" and opens[n][-1] > limit else [opens[n][-1]]) if w > limit]
            if inner:
                close(min(inner) if tag == "tr" else max(inner))
        top = stack[-1]
        says, hard, good, cls, hidden = _names(attrs, tag) if attrs and not attrs.isspace() else (False, False, False, "", False)
        named = says and tag not in ("body", "html", "main")
        role = tag in _DROP or hidden
        node = _Node(tag, _step(top.path, f"{tag}.{cls}"), top, role or named, good or tag in ("article", "main"), named and not role, named and not role and not hard)
        top.parts.append(node)
        nodes.append(node)
        if tag in _VOID or attrs.endswith("/") and tag in ("svg", "path"):
            continue
        if tag in _RAW:  # raw text: up to its end tag
            m = _ENDS[tag].search(html, at)
            end = m.start() if m else len(html)
            node.parts.append(html[at:end])
            at = text = end
            continue
        if tag not in _INLINE:
            blocks.append(len(stack))
        opens.setdefault(tag, []).append(len(stack))
        stack.append(node)
    if text < len(html):
        stack[-1].parts.append(html[text:])
    _settle(nodes)
    return root


def _settle(nodes: list[_Node]) -> None:
    """What hangs on the parts of a node, from the last node to the first, so that parts are settled before wholes.

    A class alone leaves nothing out that holds the article, and _SOFT words alone nothing in it that is prose."""
    need = 2 if any(x.tag == "article" and not x.bad for x in nodes) else 1
    for x in reversed(nodes):
        if x.doubtful and x.article and x.tag not in ("article", "li"):
            x.bad = False
        x.mass += sum(len(p.strip()) for p in x.parts if isinstance(p, str))
        if x.tag == "a":
            x.mass, x.links = 0, x.mass + x.links
        if x.soft and x.within >= need and _prose(x):
            x.bad = False
        up = x.parent
        if up is None or x.bad:
            continue
        up.heading = up.heading or x.heading or x.tag in ("h1", "h2", "h3")
        if x.tag != "header":
            up.mass += x.mass
            up.links += x.links
        up.article = up.article or x.tag in ("article", "main", "h1") or x.article and x.tag != "header"


def _prose(x: _Node) -> bool:
    """Whether a settled element reads as text: not mainly links, and long or with a paragraph or heading of its own."""
    own = any(isinstance(p, _Node) and not p.bad and p.mass and p.tag in ("p", "h1", "h2", "h3", "h4") for p in x.parts)
    return x.mass > 2 * x.links and (own or x.mass >= PROSE)


def text_of(node: _Node) -> str:
    """The node's text without what is not an article: blocks apart, character references decoded, white space one space.

    A header inside counts if it has a heading of the article, and not at the top of the page."""
    out, stack, inside = [], [iter((node,))], node.tag not in ("body", "#", "html")
    while stack:
        for p in stack[-1]:
            if isinstance(p, str):
                out.append(_html.unescape(p))
                continue
            if p is not node and (p.bad or p.tag == "header" and not (inside and p.heading)):
                out.append(" ")
                continue
            if p.tag not in _INLINE:
                out.append(" ")
                if p.parts:
                    stack.append(iter((*p.parts, " ")))
            elif p.parts:
                stack.append(iter(p.parts))
            else:
                continue
            break
        else:
            stack.pop()
    return " ".join("".join(out).split())


def _whole(node: _Node) -> _Node:
    """The lowest container that holds the article that node is in: the article or main element around it, else the highest
    one that adds text and not mainly links; the body only if it has paragraphs or headings of its own, or if all that it
    adds is prose."""
    up = node
    while up is not None:
        if up.tag in ("article", "main"):
            return up
        up = up.parent.box if up.parent else None
    while node.parent is not None and (up := node.parent.box) is not None:
        if up.tag == "body" and not any(isinstance(p, _Node) and not p.bad and p.mass and p.tag in ("p", "h1", "h2", "h3", "blockquote", "pre") for p in up.parts):
            top = node
            while top.parent is not up:
                top = top.parent
            others = [p for p in up.parts if isinstance(p, _Node) and p is not top and not p.bad and p.tag != "header" and p.mass + p.links]
            if not others or not all(map(_prose, others)):
                break
        if up.mass - node.mass < 2 * (up.links - node.links):
            break
        node = up
    return node


def _weigh(root: _Node) -> dict[int, tuple[float, int]]:
    """By generalised path: the best score of a container, by the length of its own text that is not in links, shared
    upwards with decay, and the text that containers of this path hold. A container stands for the whole article around it."""
    scores: dict[int, float] = {}
    found: dict[int, _Node] = {}
    stack = [(root, False)]
    while stack:
        x, link = stack.pop()
        if x.bad or x.tag == "header":
            continue
        link = link or x.tag == "a"
        own = 0 if link else sum(len(p.strip()) for p in x.parts if isinstance(p, str))
        up, share = x.box, 1.0
        while own > 0 and up is not None and share > 0.2:
            found[id(up)] = up
            scores[id(up)] = scores.get(id(up), 0.0) + own * share
            share *= 0.75
            up = up.parent.box if up.parent else None
        stack += [(p, link) for p in x.parts if isinstance(p, _Node)]
    out: dict[int, tuple[float, int]] = {}
    whole: dict[int, _Node] = {}
    for k, s in sorted(scores.items(), key=lambda x: -x[1])[: 4 * PATHS]:
        n = found[k]
        s *= (1.6 if n.tag in ("article", "main") else 1.25 if n.good else 1.0) * (0.5 if n.tag == "body" else 1.0)
        n = _whole(n)
        score, mass = out.get(n.path, (0.0, 0))
        out[n.path] = max(score, s), mass + (n.mass if id(n) not in whole else 0)
        whole[id(n)] = n
    return out


def _find(root: _Node, path: int) -> list[_Node]:
    """Nodes of the path that are in no part to leave out, outermost first, in page order."""
    out, stack = [], [root]
    while stack:
        x = stack.pop()
        if x is not root and (x.bad or x.tag == "header"):
            continue
        if x.path == path and x.tag in _CONTAINER:
            out.append(x)
            continue
        stack += [p for p in reversed(x.parts) if isinstance(p, _Node)]
    return out


def extract(html: str | None, paths: list[int] = ()) -> str:
    """The main text of one page: from the first of the host's paths that holds half of the text that the page's own best
    path holds, else from that one."""
    if not html:
        return ""
    root = parse(html)
    own = _weigh(root)
    best = sorted(own, key=lambda p: (-own[p][0], p))
    for path in [p for p in paths if p in own and 2 * own[p][1] >= own[best[0]][1]] + best if best else []:
        text = " ".join(filter(None, (text_of(n) for n in _find(root, path))))
        if text:
            return text
    return text_of(root)


def host_of(url):
    """The host of a url, in lower case; null and odd ones share the empty host."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def votes(pages: DataFrame) -> DataFrame:
    """host, path, votes: each page splits one vote over its containers by the squares of their scores."""

    def run(batches):
        for batch in batches:
            host, path, vote = [], [], []
            for h, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                own = _weigh(parse(text)) if text else {}
                best = sorted(((p, s) for p, (s, _) in own.items()), key=lambda x: (-x[1], x[0]))[:PATHS]
                total = sum(s * s for _, s in best)
                for p, s in best:
                    host.append(h)
                    path.append(p)
                    vote.append(s * s / total)
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(path, pa.int64()), pa.array(vote, pa.float64())], ["host", "path", "vote"])

    return pages.select(host_of("url").alias("host"), "html").mapInArrow(run, "host string, path long, vote double").groupBy("host", "path").agg(F.round(F.sum("vote"), 6).alias("votes"))


def winning_paths(voted: DataFrame) -> DataFrame:
    """host, paths: its best PATHS paths, best first; ties by path."""
    top = voted.groupBy("host").agg(F.max_by(F.struct("path"), "votes").alias("x"), F.sum("votes").alias("all"))
    good = voted.join(top, "host").where((F.col("votes") * 20 >= F.col("all")) | (F.col("path") == F.col("x.path")))
    return good.groupBy("host").agg(F.slice(F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), F.col("path").alias("path")))), 1, PATHS)["path"].alias("paths"))


def html_extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html); other columns are left out.

    Null and empty html have the empty text. A null url shares a host with other urls without one. Repeated rows are alike;
    an empty table gives an empty one. Text is whole, whatever its length. A page is parsed twice, once for the votes and
    once for its text: trees are not kept."""
    ship(pages.sparkSession)
    best = materialize(winning_paths(materialize(votes(pages))))
    small = F.broadcast(best) if rows_at_most(best, BROADCAST_HOSTS) else best
    joined = pages.select("page_id", "url", "html", host_of("url").alias("host")).join(small, "host", "left")

    def run(batches):
        for batch in batches:
            text = [extract(h, p or []) for h, p in zip(batch.column("html").to_pylist(), batch.column("paths").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array([len(t) for t in text], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return joined.select("page_id", "url", "html", "paths").mapInArrow(run, f"page_id {dict(pages.dtypes)['page_id']}, url string, text string, n_chars long")

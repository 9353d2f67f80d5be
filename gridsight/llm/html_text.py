"""Main text of web pages by scoring the tree.

Every paragraph passes points for its length and its commas to its ancestors, less with every
level; a container's points are discounted by its share of link text.  The best container is
the article, and siblings that look like it are kept with it.  Menus, headers, footers, side
bars, notices, adverts, forms, comments and code are left out before anything is scored.
"""

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .shared import table

# Element kinds of HTML, and names that mark what is not the article.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 head header hgroup html legend li main menu nav ol optgroup option p pre section select summary table tbody td "
    "template tfoot th thead tr ul svg math object audio video canvas button".split()
)
DROPPED = frozenset(
    "head nav header footer aside form button select option optgroup fieldset legend template dialog menu svg math object audio video canvas".split()
)
DROPPED_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
DROPPED_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsors promo promotion promoted banner banners "
    "cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup signin login register paywall "
    "sidebar sidebars aside rail nav navbar navigation menu menus breadcrumb breadcrumbs pagination pager masthead header footer "
    "comment comments disqus respond replies reply discussion share sharing social related recommended recommendations widget widgets "
    "toolbar copyright disclaimer skip".split()
)
#: These stand for the page or the article itself and are not left out because of their names.
NEVER_BY_NAME = frozenset("html body main".split())
ARTICLE_NAMES = frozenset("article content entry main story".split())
PARAGRAPHS = frozenset("p pre td th blockquote li dd dt h1 h2 h3 h4 h5 h6 figcaption caption summary address".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = BLOCKS - {"html", "body", "head", "button", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "option", "optgroup", "select"}
#: A start tag ends open elements of these kinds, up to the nearest element of the other kinds.
ENDS = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir"])),
    "dd": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "dt": (frozenset(["dd", "dt"]), frozenset(["dl"])),
    "tr": (frozenset(["tr"]), frozenset(["table", "tbody", "thead", "tfoot"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "option": (frozenset(["option"]), frozenset(["select", "optgroup"])),
}
#: An end tag of the first kinds ends nothing outside an open element of the second kinds.
HELD, HOLDERS = frozenset("p li dd dt div span".split()), frozenset("td th table article main".split())
SIBLING_SHARE = 0.2
MENU_LINKS, MENU_DENSITY = 3, 0.9

_NAME = re.compile(r"[a-zA-Z][^\s/>\x00]*")
_ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]*))?(?=[\s/>]|$)""", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])")


def _left_out(tag: str, attributes: str) -> bool:
    if tag in DROPPED:
        return True
    if not attributes or tag in NEVER_BY_NAME:
        return False
    names: set[str] = set()
    for m in _ATTRIBUTE.finditer(attributes):
        before = attributes[m.start() - 1 : m.start()]
        if before and not before.isspace() and before not in "\"'/":
            continue  # the end of a longer attribute name
        key, value = m[1].lower(), (m[2] or "").strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true" or key == "style" and _HIDDEN.search(value):
            return True
        if key == "role" and value.lower() in DROPPED_ROLES:
            return True
        if key in ("class", "id"):
            names.update(x.lower() for x in _PARTS.findall(value))
    bad = names & DROPPED_NAMES
    if not bad:
        return False
    if tag == "article":
        return bool(bad & {"comment", "comments", "reply", "ad", "ads", "advert", "sponsored", "promo", "related"})
    # "article-content with-sidebar" is the article; "article-comments" is not
    return not (names & ARTICLE_NAMES and bad <= {"header", "sidebar", "menu", "nav", "footer", "share", "social", "banner", "comments"} and names & {"with", "has", "no"})


class _Page:
    """The block elements of one page as parallel lists, and its text in segments.

    A segment is a run of text in one block element without another block in between.
    """

    def __init__(self) -> None:
        self.parent, self.tag, self.gone = [-1], ["#root"], [False]
        self.open, self.segments = [0], []  # segments: (element, text, length of link text, links)
        self.depths: dict[str, list[int]] = {}  # per tag, how deep its open elements lie
        self.parts: list[str] = []
        self.link_parts, self.links, self.anchor_at = 0, 0, 0  # anchor_at: depth of the block that holds the open link

    def flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            if text:
                self.segments.append((self.open[-1], text, min(self.link_parts, len(text)), self.links))
            self.parts = []
        self.link_parts = self.links = 0

    def text(self, raw: str) -> None:
        if self.gone[self.open[-1]]:
            return
        piece = entities.unescape(raw) if "&" in raw else raw
        self.parts.append(piece)
        if self.anchor_at:
            self.link_parts += len(" ".join(piece.split()))

    def pop_to(self, size: int) -> None:
        self.flush()
        for i in self.open[size:]:
            self.depths[self.tag[i]].pop()
        del self.open[size:]
        if self.anchor_at > size:
            self.anchor_at = 0

    def deepest(self, tags: frozenset[str]) -> int:
        """The depth of the innermost open element of one of these tags; 0 if there is none."""
        return max((d[-1] for t in tags if (d := self.depths.get(t))), default=0)

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br" or tag == "hr":
            self.parts.append(" ")
            if tag == "hr":
                self.flush()
        elif tag == "a":
            if not self.gone[self.open[-1]]:
                self.anchor_at = len(self.open)
                self.links += 1
        elif tag in BLOCKS:
            if tag in CLOSES_P:
                for at in range(len(self.open) - 1, 0, -1):
                    kind = self.tag[self.open[at]]
                    if kind == "p":
                        self.pop_to(at)
                        break
                    if kind not in HEADINGS:
                        break
            if tag in ENDS:
                at = self.deepest(ENDS[tag][0])
                if at > self.deepest(ENDS[tag][1]):
                    self.pop_to(at)
            if tag in HEADINGS and self.tag[self.open[-1]] in HEADINGS:
                self.pop_to(len(self.open) - 1)
            self.flush()
            up = self.open[-1]
            self.parent.append(up)
            self.tag.append(tag)
            self.gone.append(self.gone[up] or _left_out(tag, attributes))
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append(len(self.parent) - 1)

    def end(self, tag: str) -> None:
        if tag == "a":
            self.anchor_at = 0
        elif tag == "br":
            self.parts.append(" ")
        elif tag in BLOCKS and tag not in ("html", "body"):
            at = self.deepest(HEADINGS if tag in HEADINGS else frozenset([tag]))
            if at > (self.deepest(HOLDERS) if tag in HELD else 0):
                self.pop_to(at)
                return
            self.flush()


def parse(page: str) -> _Page:
    """One pass over the page.  Every search goes forward only, so the work grows with the length."""
    out, at, n, missing = _Page(), 0, len(page), set()

    def find(what: str, start: int) -> int:
        """Like str.find; what was once not found is not looked for again."""
        if what in missing:
            return -1
        found = page.find(what, start)
        if found < 0:
            missing.add(what)
        return found

    while at < n:
        open_at = find("<", at)
        if open_at < 0:
            out.text(page[at:])
            break
        if open_at > at:
            out.text(page[at:open_at])
        follow = page[open_at + 1 : open_at + 2]
        if page.startswith("<!--", open_at):
            to = find("-->", open_at + 2)  # <!--> is a comment too
            at = n if to < 0 else to + 3
            continue
        if follow in ("!", "?"):
            to = find(">", open_at)
            at = n if to < 0 else to + 1
            continue
        closing = follow == "/"
        m = _NAME.match(page, open_at + 1 + closing)
        if not m:
            if closing:
                to = find(">", open_at)
                at = n if to < 0 else to + 1
            else:
                out.text("<")
                at = open_at + 1
            continue
        tag, i = m[0].lower(), m.end()
        # the tag ends at the first ">" outside quotes; a quote counts only after "="
        while True:
            to = find(">", i)
            if to < 0:
                to = n
                break
            quoted = -1
            for q in ('="', "='"):
                k = page.find(q, i, to)
                if k >= 0 and (quoted < 0 or k < quoted):
                    quoted = k
            if quoted < 0:
                break
            end_quote = find(page[quoted + 1], quoted + 2)
            if end_quote < 0:
                break
            if end_quote < to:
                i = end_quote + 1
                continue
            i = end_quote + 1
        attributes = page[m.end() : to]
        at = min(n, to + 1)
        if closing:
            out.end(tag)
            continue
        if tag in RAW:
            close = re.compile(f"</{tag}(?=[\\s/>])", re.I)
            found = None if f"/{tag}" in missing else close.search(page, at)
            if found is None:
                missing.add(f"/{tag}")
                at = n if tag in ("script", "style", "textarea", "title") else at
            else:
                to = find(">", found.end())
                at = n if to < 0 else to + 1
            continue
        if tag not in VOID or tag in ("br", "hr"):
            out.start(tag, attributes)
    out.flush()
    return out


def main_text(page: str | None) -> str:
    """The blocks of the article, white space reduced, one per line; empty if there is none."""
    if not page:
        return ""
    tree = parse(page)
    parent, tag = tree.parent, tree.tag
    kept = [s for s in tree.segments if not tree.gone[s[0]]]
    if not kept:
        return ""
    size = len(parent)
    length, linked, links, points = [0] * size, [0] * size, [0] * size, [0.0] * size
    for owner, text, link_length, n_links in kept:
        length[owner] += len(text)
        linked[owner] += link_length
        links[owner] += n_links
        worth = min(len(text), 25) / 25 + text.count(",") + len(text) / 100
        worth *= 1 - link_length / len(text)
        up = parent[owner] if tag[owner] in PARAGRAPHS and parent[owner] >= 0 else owner
        share = 1.0
        for _ in range(5):
            points[up] += worth * share
            if parent[up] < 0:
                break
            up, share = parent[up], share / 2
    for i in range(size - 1, 0, -1):  # children come after their parents
        length[parent[i]] += length[i]
        linked[parent[i]] += linked[i]
        links[parent[i]] += links[i]
    score = [p * (1 - linked[i] / length[i]) if length[i] else 0.0 for i, p in enumerate(points)]
    best = max(range(size), key=lambda i: (score[i], -i))
    whole = best
    while whole > 0 and tag[whole] not in ("article", "main"):
        whole = parent[whole]
    best = whole if whole > 0 else best

    menu = [tag[i] in ("ul", "ol", "dir", "dl", "table") and links[i] >= MENU_LINKS and linked[i] >= MENU_DENSITY * length[i] for i in range(size)]
    inside = [False] * size  # in the article, and in no menu
    inside[best] = True
    around = parent[best]
    for i in range(1, size):
        up = parent[i]
        if i != best and (inside[up] or up == around and around >= 0 and _like(tag[i], score[i], score[best], length[i], linked[i])):
            inside[i] = not menu[i]
    return "\n".join(text for owner, text, link_length, _ in kept if inside[owner] or owner == around and link_length < 0.25 * len(text))


def _like(tag: str, score: float, best: float, length: int, linked: int) -> bool:
    """Whether a sibling of the best container belongs to it."""
    if not length or linked > 0.25 * length:
        return False
    return tag in PARAGRAPHS or score >= SIBLING_SHARE * best


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(page.as_py()) for page in batch.column(2)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page; other columns are ignored.

    A null or empty page, and one of menus only, has an empty text.  Repeated rows are kept.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).cast("string").alias("html"))
    out = rows.mapInArrow(_extract, f"page_id {rows.schema['page_id'].dataType.simpleString()}, url string, text string")
    return out.select("page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))

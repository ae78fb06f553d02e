"""Main text of web pages by tag-path ratios."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

# Elements of HTML by how their text counts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("head script style noscript template textarea select option button svg iframe object canvas audio video map datalist dialog annotation annotation-xml".split())
#: Of these, the ones that end the block they stand in.
SILENT_BORDERS = frozenset("head dialog option".split())
BOILERPLATE = frozenset("nav header footer aside form menu fieldset".split())
#: Kinds that are also put around whole pages: such an element is furniture only if it has less than half of the text.
WRAPPING = frozenset("form fieldset menu header".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q ruby rb rt rp s samp small span "
    "strike strong sub sup time tt u var br img wbr "
    "math semantics mrow mi mn mo ms mtext mspace mfrac msqrt mroot msub msup msubsup munder mover munderover mstyle mpadded menclose".split()
)
CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote center details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
    "menu nav ol p pre section table ul".split()
)
CONTAINERS = frozenset("article main section div td body blockquote center".split())
#: What names say of furniture. A name counts whole: words that say nothing of the kind, such as `work` in `related-work`, weaken it.
READERS_WORDS = frozenset("comment comments commentlist disqus replies".split())
ADVERT_WORDS = frozenset("ad ads advert adverts advertisement advertisements".split())
CONSENT_WORDS = frozenset("cookie cookies consent gdpr".split())
DIALOG_WORDS = frozenset("banner notice alert popup modal overlay".split())
FURNITURE_WORDS = (
    READERS_WORDS | ADVERT_WORDS | CONSENT_WORDS | DIALOG_WORDS
    | frozenset(
        "advertising sponsor sponsored promo promotion reply respond sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header "
        "masthead share sharing social related recommended newsletter subscribe signup login search pagination pager widget toolbar skiplink".split()
    )
)
PLAIN_WORDS = frozenset(
    "site main top bottom left right primary secondary global inner outer wrapper wrap container box area block section bar list item items "
    "link links button buttons icons row col column group panel form count wp js the slot unit google".split()
)
READERS_PLAIN_WORDS = PLAIN_WORDS | frozenset("post entry article blog page content body text title meta author user users reader readers all new fb facebook thread".split())
NAMED = frozenset("div section ul ol dl table td center".split())
#: Comments and adverts also go by the names of these.
NAMED_PARTS = NAMED | frozenset("li tr tbody dd figure blockquote".split())
#: How far a name is believed: never, if links and text tell the same, if the text tells the same, always.
NO_NAME, HINT, NAME, CERTAIN = range(4)
#: Names such as `with-sidebar` tell of the layout around, and `userComments` is two words.
LAYOUT_NAMES = re.compile(r"\b(?:with|without|has|no|show|hide)[-_]\w+", re.I)
HUMP = re.compile(r"(?<=[a-z])(?=[A-Z])")
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar".split())
WRAPPING_ROLES = frozenset("search dialog alert alertdialog menu banner".split())
#: Names that tell what stands beside an article even if it is written like one; and names that threads of readers' words go by.
BESIDE_WORDS = frozenset("sidebar related recommended newsletter promo promotion sponsored advertising".split())
THREAD_WORDS = READERS_WORDS | frozenset(
    "respond response responses reply feedback discussion discussions talkback opinions reactions guestbook thread threads".split()
)
#: What a line above or below somebody's words says: a time ago, a date, a time of day, an answer to it.
BYLINE = re.compile(
    r"\b(?:ago|says|said|wrote|writes|replied|reply|posted|yesterday|today)\b|\b\d{1,2}:\d{2}\b|\b\d{4}-\d{2}-\d{2}\b|\b\d{1,2}[./]\d{1,2}[./]\d{2,4}\b"
    r"|\b(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.? \d{1,2}\b|\b\d{1,2}\.? (?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)", re.I
)
LONGEST_BYLINE = 80
PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？؟،]")


#: Elements that another start tag may close, or that keep it from closing any further out.
NOTABLE = CONTAINERS | frozenset(CLOSES_ITSELF) | frozenset("ul ol dl table".split())


def words_of_names(classes: str, ident: str) -> list[set[str]]:
    """The words of each name of an element."""
    said = LAYOUT_NAMES.sub(" ", HUMP.sub("-", f"{classes} {ident}")).lower().replace("side-bar", "sidebar")
    return [{w for w in re.split("[-_]+", name) if w and not w.isdigit()} for name in said.split()]


def strength_of(tag: str, classes: str, ident: str) -> int:
    """How far the class and id of an element are believed to name page furniture."""
    if tag not in NAMED_PARTS:
        return NO_NAME
    best = NO_NAME
    for names, slug in ((classes, False), (ident, tag not in ("div", "ul", "ol", "table"))):
        said = LAYOUT_NAMES.sub(" ", HUMP.sub("-", names)).lower().replace("side-bar", "sidebar").replace("skip-link", "skiplink")
        for name in said.split():
            words = {w for w in re.split("[-_]+", name) if w and not w.isdigit()}
            known = words & FURNITURE_WORDS
            if not known:
                continue
            if known & READERS_WORDS and words <= FURNITURE_WORDS | READERS_PLAIN_WORDS:
                return CERTAIN
            whole = words <= FURNITURE_WORDS | PLAIN_WORDS
            if whole and not slug and (known & ADVERT_WORDS or (known & CONSENT_WORDS and (known & DIALOG_WORDS or len(known) > 1))):
                return CERTAIN
            if tag in NAMED:
                best = max(best, NAME if whole else HINT)
    return best


class Node:
    """An element: its place in the tree and what is known of it when it opens.

    Elements are numbered as they open, and those inside one are numbered up to its `last`, so being inside is two comparisons. A path is
    the number of (path above, name), so a deep page has no long texts. `hard` tells that it or one above it is furniture by its kind,
    `soft` that its own kind is one that wraps whole pages too; `furniture` is settled once the page is read.
    """

    __slots__ = ("tag", "parent", "path", "number", "last", "depth", "linked", "strength", "hard", "soft", "beside", "threaded", "furniture", "block", "notable")

    def __init__(self, tag: str, parent: Node | None, path: int, number: int, linked: bool):
        self.tag, self.parent, self.path, self.number, self.last, self.linked = tag, parent, path, number, number, linked
        self.depth = parent.depth + 1 if parent else 0
        self.hard = bool(parent) and parent.hard
        self.strength, self.soft, self.beside, self.threaded, self.furniture = NO_NAME, False, False, False, False
        # The nearest element that holds blocks, and the nearest that may have to be closed or stops the search for one.
        self.block = parent.block if parent and tag in INLINE else self
        self.notable = self if not parent or tag in NOTABLE else parent.notable


class Block:
    """A run of text between two borders of blocks."""

    __slots__ = ("node", "parts", "text", "linked")

    def __init__(self, node: Node):
        self.node, self.parts, self.text, self.linked = node, [], "", 0


class PageReader(HTMLParser):
    """Collects the blocks of a page in order, without the text of silent elements."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.top = self.root = Node("#", None, 0, 0, False)
        self.nodes = [self.root]
        self.paths: dict[tuple[int, str], int] = {}
        self.opened: dict[str, int] = defaultdict(int)
        self.silent: list[str] = []
        self.blocks: list[Block] = []
        self.named: dict[tuple[str, str, str], tuple[int, bool, bool]] = {}
        self.border = True

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.silent:
            if self.silent[0] == "head" and tag in ("body", "article", "main", "div", "p", "nav"):
                self.silent.clear()  # an unclosed head ends where the body begins
            else:
                if tag in SILENT:
                    self.silent.append(tag)
                return
        if tag in SILENT:
            # What is silent inside a block leaves the block whole.
            self.border = self.border or tag in SILENT_BORDERS
            self.silent.append(tag)
            return
        if tag not in INLINE:
            self.border = True
        if tag in VOID:
            if self.blocks and not self.border:
                self.blocks[-1].parts.append(" ")
            return
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, until=CONTAINERS)
        if tag in CLOSES_ITSELF:
            self._close(CLOSES_ITSELF[tag], until=CONTAINERS | {"ul", "ol", "dl", "table"} - CLOSES_ITSELF[tag])
        known = dict(attrs)
        classes, ident = known.get("class") or "", known.get("id") or ""
        name = ".".join([tag, *sorted(f"{classes} {ident}".split())]) if tag not in ("html", "body") else tag
        path = self.paths.setdefault((self.top.path, name), len(self.paths) + 1)
        node = Node(tag, self.top, path, len(self.nodes), self.top.linked or tag == "a")
        if tag not in ("html", "body", "article", "main"):
            role = (known.get("role") or "").lower()
            node.soft = tag in WRAPPING or role in WRAPPING_ROLES
            node.hard = node.hard or "hidden" in known or (not node.soft and (tag in BOILERPLATE or role in BOILERPLATE_ROLES))
            if (said := (tag, classes, ident)) not in self.named:
                words = words_of_names(classes, ident)
                whole = tag in NAMED and any(w & BESIDE_WORDS and w <= FURNITURE_WORDS | PLAIN_WORDS for w in words[: len(classes.split())] or words)
                self.named[said] = strength_of(*said), whole, any(w & THREAD_WORDS for w in words)
            node.strength, node.beside, node.threaded = self.named[said]
        self.nodes.append(node)
        self.opened[tag] += 1
        self.top = node

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in SILENT:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.silent:
            if tag in self.silent:
                del self.silent[self.silent.index(tag) :]
            return
        if tag not in INLINE:
            self.border = True
        if not self.opened[tag]:
            return
        node = self.top
        while node is not self.root and node.tag != tag:
            if tag in INLINE and node.tag not in INLINE:
                return  # an inline end tag does not close a block
            node = node.parent
        if node is not self.root:
            self._leave(node)

    def handle_data(self, data: str) -> None:
        if self.silent:
            return
        if self.border:
            if not data.strip():
                return
            self.blocks.append(Block(self.top.block))
            self.border = False
        block = self.blocks[-1]
        block.parts.append(data)
        if self.top.linked:
            block.linked += len(data.strip())

    def _close(self, tags: set[str], until: frozenset[str]) -> None:
        if not any(self.opened[tag] for tag in tags):
            return
        node = self.top.notable
        while node is not self.root and node.tag not in until:
            if node.tag in tags:
                self._leave(node)
                return
            node = node.parent.notable

    def _leave(self, node: Node) -> None:
        """Closes an element and all that is open inside it."""
        while self.top is not node.parent:
            self.opened[self.top.tag] -= 1
            self.top = self.top.parent


class Page:
    """The blocks with text of a page, in page order, and its elements in the order in which they open."""

    def __init__(self, html: str):
        reader = PageReader()
        reader.feed(html)
        reader.close()
        self.nodes = reader.nodes
        for node in reversed(self.nodes):
            if node.parent:
                node.parent.last = max(node.parent.last, node.last)
        for block in reader.blocks:
            block.text = " ".join("".join(block.parts).split())
        self.blocks = [b for b in reader.blocks if b.text]

    def sums(self, blocks: list[Block], value: Callable[[Block], float]) -> list[float]:
        """For each element the sum of a value over the blocks inside it; every element is looked at once."""
        total = [0] * len(self.nodes)
        for block in blocks:
            total[block.node.number] += value(block)
        for node in reversed(self.nodes):
            if node.parent:
                total[node.parent.number] += total[node.number]
        return total


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page with text, in page order; white space inside a block is one space."""
    return Page(html).blocks


def settle_furniture(page: Page) -> None:
    """Marks the elements that are furniture: by kind, by a name that the element's text bears out, or as a thread of readers' words.

    Comments and adverts are furniture whatever their size. Kinds that wrap whole pages too, and names of what stands beside an article, hold for
    elements with less than half of the text. Other names are believed where each tag path inside has less than half of the text a block, links
    aside, of the page's best path; a name with words of another kind only if most of the text is in links as well.
    """
    certain = [False] * len(page.nodes)
    for node in page.nodes[1:]:
        certain[node.number] = certain[node.parent.number] or node.strength == CERTAIN
    open_blocks = [b for b in page.blocks if not b.node.hard and not certain[b.node.number]]
    length, number = defaultdict(int), defaultdict(int)
    for block in open_blocks:
        number[block.node.path] += 1
        length[block.node.path] += max(0, len(block.text) - block.linked)
    ratios = {path: length[path] / n for path, n in number.items()}
    best = max(ratios.values(), default=0)
    text, linked = page.sums(open_blocks, lambda b: len(b.text)), page.sums(open_blocks, lambda b: b.linked)
    highest = [-1.0] * len(page.nodes)
    for block in open_blocks:
        highest[block.node.number] = max(highest[block.node.number], ratios[block.node.path])
    for node in reversed(page.nodes):
        if node.parent:
            highest[node.parent.number] = max(highest[node.parent.number], highest[node.number])
    threads = thread_parents(page, open_blocks, text)

    def believed(node: Node) -> bool:
        own = node.number
        if node.strength == CERTAIN or own in threads:
            return True
        minor = text[own] * 2 < text[0]
        if (node.soft or node.beside) and minor:
            return True
        if node.strength == NO_NAME or (node.strength == HINT and linked[own] * 2 <= text[own]):
            return False
        return highest[own] * 2 < best

    for node in page.nodes[1:]:
        node.furniture = node.hard or node.parent.furniture or believed(node)


def thread_parents(page: Page, blocks: list[Block], text: list[float]) -> set[int]:
    """The elements that hold a thread of readers' words: several elements of one name, most of them with a byline of their own.

    A byline is a short block with a date, a time or a word such as `wrote`. A thread is believed if a name of it or around it tells of one, or if it has
    less than half of the text and follows the longest block of the page.
    """
    lines = [False] * len(page.nodes)
    longest = max(blocks, key=lambda b: len(b.text) - b.linked, default=None)
    for block in blocks:
        if len(block.text) <= LONGEST_BYLINE and BYLINE.search(block.text):
            lines[block.node.number] = True
    for node in reversed(page.nodes):
        if node.parent and lines[node.number]:
            lines[node.parent.number] = True
    entries: dict[tuple[int, int], list[Node]] = defaultdict(list)
    told = [False] * len(page.nodes)
    for node in page.nodes[1:]:
        told[node.number] = told[node.parent.number] or (node.threaded and node.tag not in ("html", "body", "article", "main"))
        # An entry has words beside its byline.
        if node.tag in NAMED_PARTS | {"article"} and text[node.number] > 0:
            entries[node.parent.number, node.path].append(node)
    found = set()
    for (parent, _path), own in entries.items():
        if len(own) < 2 or sum(lines[n.number] for n in own) * 3 < len(own) * 2:
            continue
        share = sum(text[n.number] for n in own)
        after = longest is not None and own[0].number > longest.node.number
        if any(told[n.number] for n in own) or (after and len(own) > 2 and share * 2 < text[0]):
            # The entries alone are taken where they share their parent with other text.
            found |= {n.number for n in own} if share * 10 < text[parent] * 9 or page.nodes[parent].tag in ("body", "main", "article") else {parent}
    return found


def smoothed(values: np.ndarray, radius: int = 1) -> np.ndarray:
    """Gaussian smoothing over neighbouring blocks."""
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / max(radius, 1)) ** 2)
    padded = np.pad(values, radius, mode="edge")
    return np.convolve(padded, weights / weights.sum(), mode="valid")


def path_scores(blocks: list[Block]) -> np.ndarray:
    """For each block the fused ratio of its tag path.

    Text length and punctuation are summed per path from the root and divided by the path's number of blocks; text in links does
    not count. Both are smoothed along the page, each is taken as a share of its maximum, and their geometric mean is the score.
    """
    length, points, number = defaultdict(int), defaultdict(int), defaultdict(int)
    for block in blocks:
        path = block.node.path
        number[path] += 1
        length[path] += max(0, len(block.text) - block.linked)
        points[path] += len(PUNCTUATION.findall(block.text)) if block.linked * 2 <= len(block.text) else 0
    ratios = [np.array([sums[b.node.path] / number[b.node.path] for b in blocks]) for sums in (length, points)]
    shares = [(s := smoothed(r)) / s.max() if r.max() > 0 else r for r in ratios]
    return np.sqrt(shares[0] * (shares[1] if ratios[1].max() > 0 else shares[0]))


def content_paths(blocks: list[Block], scores: np.ndarray) -> set[int]:
    """Paths whose mean score reaches the threshold: the deviation of all scores, at most half of the best path's mean."""
    mean, furniture = {}, {b.node.path for b in blocks if b.node.furniture}
    by_path = defaultdict(list)
    for block, score in zip(blocks, scores, strict=True):
        by_path[block.node.path].append(score)
    mean = {path: sum(v) / len(v) for path, v in by_path.items() if path not in furniture}
    if not mean:
        return set()
    least = min(float(scores.std()), max(mean.values()) / 2)
    return {path for path, value in mean.items() if value > 0 and value >= least}


def container(page: Page, own: list[Block], paths: set[int]) -> Node | None:
    """The element that holds most of the content: the deepest with over half of the text of the content paths, widened to the article around it."""
    chosen = [b for b in own if b.node.path in paths]
    if not chosen:
        return None
    weight = page.sums(chosen, lambda b: len(b.text))
    held = [n for n in page.nodes if n.tag in CONTAINERS and weight[n.number] * 2 > weight[0]]
    best = max(held, key=lambda n: n.depth, default=None)
    if best is None:
        return max((n for n in page.nodes if weight[n.number]), key=lambda n: (weight[n.number], -n.depth))
    node, outer = best, None
    while node:
        if node.tag in ("article", "main"):
            outer = outer if outer is not None and outer.tag == "article" else node
        node = node.parent
    if outer is not None:
        return outer
    text, linked, number = page.sums(own, lambda b: len(b.text)), page.sums(own, lambda b: b.linked), page.sums(own, lambda b: 1)

    def link_list(outer: int, inner: int) -> bool:
        """Whether what one element holds beside another is mostly links."""
        return number[outer] > number[inner] and (linked[outer] - linked[inner]) * 2 > text[outer] - text[inner]

    while best.parent and best.parent.tag in CONTAINERS and best.parent.tag != "body" and not link_list(best.parent.number, best.number):
        best = best.parent
    return best


def common_ancestor(nodes: list[Node]) -> Node:
    """The deepest element that holds all of `nodes`."""
    low, high = min(n.number for n in nodes), max(n.number for n in nodes)
    found = nodes[0]
    while not (found.number <= low and high <= found.last):
        found = found.parent
    return found


def content_blocks(page: Page, paths: set[int]) -> list[Block]:
    """The blocks of the article in page order: all on a content path, and what the elements around them add.

    The element that holds most of the content adds all it has. The element that holds all of the content adds each part that is
    not mostly links. Page furniture is left out.
    """
    own = [b for b in page.blocks if not b.node.furniture]
    content = [b.node for b in own if b.node.path in paths]
    if not content:
        return []
    found, around, wanted = container(page, own, paths), common_ancestor(content), {n.number for n in content}
    text, linked = page.sums(own, lambda b: len(b.text)), page.sums(own, lambda b: b.linked)
    holds = [bool(n) for n in page.sums([b for b in own if b.node.number in wanted], lambda _b: 1)]
    # The outermost element around each that holds none of the content.
    part = [n.number for n in page.nodes]
    for node in page.nodes[1:]:
        if not holds[node.number] and not holds[node.parent.number]:
            part[node.number] = part[node.parent.number]

    def added(block: Block) -> bool:
        if not _inside(block.node, around):
            return False
        if holds[block.node.number]:
            return block.linked * 2 <= len(block.text)
        return linked[part[block.node.number]] * 2 <= text[part[block.node.number]]

    return [b for b in own if b.node.number in wanted or _inside(b.node, found) or added(b)]


def _inside(node: Node, outer: Node) -> bool:
    return outer.number <= node.number <= outer.last


def main_text(html: str) -> str:
    """The article of a page, one block per line; an empty text if the page has none."""
    page = Page(html)
    if not page.blocks:
        return ""
    settle_furniture(page)
    scores = path_scores(page.blocks)
    return "\n".join(b.text for b in content_blocks(page, content_paths(page.blocks, scores)))


def extract_pages(pages: DataFrame, html_col: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns `keep` with `text` and `n_chars`, its code points, for every row.

    A null or empty page, or one without an article, gives an empty text. Rows repeat as they do in the input; nulls in the columns kept
    stay; other columns are dropped, so that a column called `text` in the input does no harm. An empty table gives an
    empty result.
    """
    kept = [pages[c] for c in keep]
    chosen = pages.select(*kept, F.coalesce(pages[html_col], F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_slices(batches):
            texts = pa.array([main_text(html) for html in part.column("text").to_pylist()], part.schema.field("text").type)
            yield part.set_column(part.schema.get_field_index("text"), "text", texts)

    return chosen.mapInArrow(run, chosen.schema).withColumn("n_chars", F.length("text").cast("long"))

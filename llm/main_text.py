"""Main text of web pages by two passes of block rules.

A page is cut into blocks at block-level tags. The first pass decides what it can: a block in a container that
names its role (menu, footer, advert, comments ...) is out; one that is mostly links is out; one that is long and
rich in stop words is in. Short blocks, and longer ones with few stop words, stay open. In the second pass an
open block takes the label of its nearest decided neighbours in the same container, else in the same article
(outside articles, on the page); when the two sides differ the nearer one counts, and at equal distance an article
keeps the block. In an article only blocks that were decided by their text are asked, since an advert says nothing
about the paragraph after it.
Without any decided neighbour a block stays in an article; outside, it stays if the page has no article and it is long.

Markup is read as browsers do where it matters: script, style and the like hold no tags, comments end at -->,
a tag cut off by the end of the page is no text, unclosed elements end with the container around them.

Defined results: null or empty html gives an empty text; repeated rows are judged alike, each on its own;
pages of any length are read whole, in time linear in their length; broken UTF-8 reads as replacement characters;
only the three named columns are read, so other columns may have any name; an empty table gives no rows.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters from which a block can be decided by its words, the share of stop words that decides, and of linked characters.
LONG, RICH, LINKED = 70, 0.2, 0.5

# --- fixed values: frequent function words of the languages known, element names, names of containers ---------------
STOP_WORDS = {
    "en": "a an and are as at be but by for from has have he her his i in is it its not of on or she that the their they this to was we were which will with you",
    "fr": "à au aux avec ce ces cette dans de des du elle en est et il ils je la le les leur mais ne nous on ou par pas plus pour que qui sa se ses son sont sur un une vous",
    "de": "aber als am an auch auf aus bei das dem den der des die ein eine einen einer er es für hat ich im in ist mit nach nicht noch oder sich sie sind so über um und von war wie wir zu zum zur",
    "es": "a al como con de del el ella en entre era es esta este ha la las le lo los más me muy no o para pero por que se si sin sobre son su sus un una y ya",
}
RAW_TEXT = frozenset("script style title textarea iframe noembed noframes xmp noscript template svg math object select".split())
BLOCK = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
CONTAINER = BLOCK - frozenset("col h1 h2 h3 h4 h5 h6 hr p dd dt li option optgroup td th tr".split())
ARTICLE = frozenset({"article", "main"})
OUT_ELEMENTS = frozenset("aside button dialog fieldset footer form head menu nav search".split())
OUT_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
OUT_NAMES = frozenset(
    "ad ads adsense advert advertisement advertising adverts aside banner breadcrumb breadcrumbs byline comment commentlist comments consent "
    "cookie cookies copyright disclaimer disqus feedback footer footnav gdpr legal login masthead menu modal nav navbar navigation navi "
    "newsletter notice notices notification overlay pager pagination popup promo promotion promotions recommendations recommended related "
    "replies reply respond responses search share sharing shoutbox sidebar signup skip social sponsor sponsored sponsors subscribe subscription "
    "teaser toolbar topbar widget widgets".split()
)
QUALIFIED = frozenset({"has", "no", "not", "with", "without"})
# --- end of fixed values --------------------------------------------------------------------------------------

ALL_STOP_WORDS = frozenset(w for words in STOP_WORDS.values() for w in words.split())
MARKUP = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<[!?/](?![a-zA-Z])[^>]*+>?|<![^>]*+>?|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<rest>(?:[^>"']++|"[^"]*+"|'[^']*+')*+>|[^>]*+>?)""",
    re.DOTALL,
)
ATTRIBUTE = re.compile(r"""(?P<key>[^\s"'<>/=]++)\s*+(?:=\s*+(?:"(?P<a>[^"]*+)"?|'(?P<b>[^']*+)'?|(?P<c>[^\s"'>]++)))?""")
WORD = re.compile(r"[^\W\d_]+")


@dataclass(slots=True)
class Block:
    text: str
    article: int  # number of the article it is in, 0 outside
    out: bool  # its container says so
    linked: int  # characters in links
    container: int = 0  # number of the innermost container


@dataclass(slots=True)
class _Open:
    name: str
    out: bool
    article: int
    number: int = 0


def _attributes(rest: str) -> dict[str, str]:
    return {m["key"].lower(): m["a"] or m["b"] or m["c"] or "" for m in ATTRIBUTE.finditer(rest.rstrip(">"))}


def _is_out(name: str, rest: str, in_article: bool) -> bool:
    """Whether an element says that it holds no main text."""
    if name in OUT_ELEMENTS or (name == "header" and not in_article):
        return True
    if len(rest) < 4 or name in ("html", "body", "main"):
        return False
    found = _attributes(rest)
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", found.get("style", ""), re.IGNORECASE):
        return True
    if found.get("role", "").lower() in OUT_ROLES:
        return True
    for name_of in f"{found.get('class', '')} {found.get('id', '')}".lower().split():
        parts = re.split(r"[^a-z0-9]+", name_of)
        # Of an article's own names only whole ones count: some say whether comments are open.
        if name_of in OUT_NAMES or (name != "article" and parts[0] not in QUALIFIED and not OUT_NAMES.isdisjoint(parts)):
            return True
    return False


@dataclass(slots=True)
class _Reader:
    blocks: list[Block] = field(default_factory=list)
    open: list[_Open] = field(default_factory=lambda: [_Open("", False, 0)])
    names: dict[str, int] = field(default_factory=dict)  # how many containers of a name are open
    pieces: list[str] = field(default_factory=list)
    linked: int = 0
    in_link: bool = False
    articles: int = 0
    containers: int = 0

    def add(self, text: str) -> None:
        if text:
            plain = html.unescape(text) if "&" in text else text
            self.pieces.append(plain)
            if self.in_link:
                self.linked += len("".join(plain.split()))

    def end_block(self) -> None:
        if self.pieces:
            if text := " ".join("".join(self.pieces).split()):
                inner = self.open[-1]
                self.blocks.append(Block(text, inner.article, inner.out, self.linked, inner.number))
            self.pieces = []
        self.linked, self.in_link = 0, False

    def start(self, name: str, rest: str) -> None:
        if name == "a":
            self.in_link = "href" in rest.lower()
        elif name == "br":
            self.pieces.append(" ")
        elif name in BLOCK:
            self.end_block()
            if name in CONTAINER and name not in ("html", "hr"):
                above = self.open[-1]
                article = above.article
                if name in ARTICLE and not article:
                    self.articles += 1
                    article = self.articles
                self.containers += 1
                self.open.append(_Open(name, above.out or _is_out(name, rest, bool(above.article)), article, self.containers))
                self.names[name] = self.names.get(name, 0) + 1

    def end(self, name: str) -> None:
        if name == "a":
            self.in_link = False
        elif name in BLOCK:
            self.end_block()
            if self.names.get(name):
                while True:
                    closed = self.open.pop().name
                    self.names[closed] -= 1
                    if closed == name:
                        break


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page, in its order."""
    reader, at, size = _Reader(), 0, len(page)
    while at < size:
        found = MARKUP.search(page, at)
        if not found:
            reader.add(page[at:])
            break
        reader.add(page[at : found.start()])
        at = found.end()
        if not found["name"] or not found["rest"].endswith(">"):
            continue  # a comment, or a tag that the page's end cuts off
        name = found["name"].lower()
        if found["end"]:
            reader.end(name)
            continue
        reader.start(name, found["rest"])
        if name in RAW_TEXT and not found["rest"].endswith("/>"):
            close = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.IGNORECASE).search(page, at)
            at = close.end() if close else size
    reader.end_block()
    return reader.blocks


def first_pass(block: Block, stop_words: frozenset[str] = ALL_STOP_WORDS) -> bool | None:
    """True and False where the block itself decides, None where it is open."""
    size = len(block.text)
    if block.out or block.linked > LINKED * size:
        return False
    if size < LONG:
        return None
    words = WORD.findall(block.text.lower())
    stops = sum(w in stop_words for w in words)
    return True if stops and stops >= RICH * len(words) else None


def second_pass(blocks: list[Block], labels: list[bool | None]) -> list[bool]:
    """Open blocks take the label of the nearest decided ones; linear, by one sweep each way."""
    has_article = any(b.article for b in blocks)

    def sweep(order: range) -> list[list[tuple[bool, int]]]:
        """Per block the last decided one in its container and in its article, as (label, distance) where there is one."""
        last: dict[tuple, tuple[bool, int]] = {}
        seen: list[list] = [[None, None] for _ in blocks]
        for k in order:
            b = blocks[k]
            places = ("container", b.container), ("article", b.article)
            if labels[k] is None:
                seen[k] = [(last[p][0], abs(k - last[p][1])) if p in last else None for p in places]
            elif not (b.article and b.out):
                last.update(dict.fromkeys(places, (labels[k], k)))
        return seen

    before, after = sweep(range(len(blocks))), sweep(range(len(blocks) - 1, -1, -1))
    final = []
    for b, label, sides in zip(blocks, labels, zip(before, after, strict=True), strict=True):
        if label is None:
            near = next((found for place in (0, 1) if (found := [x[place] for x in sides if x[place]])), [])
            if not near:
                label = bool(b.article) or (not has_article and len(b.text) >= LONG)
            elif len(near) == 2 and near[0][1] == near[1][1] and near[0][0] != near[1][0]:
                label = bool(b.article)
            else:
                label = min(near, key=lambda x: x[1])[0]
        final.append(label)
    return final


def main_text(page: str, stop_words: frozenset[str] = ALL_STOP_WORDS) -> str:
    blocks = blocks_of(page)
    kept = second_pass(blocks, [first_pass(b, stop_words) for b in blocks])
    return "\n".join(b.text for b, keep in zip(blocks, kept, strict=True) if keep)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", content: str = "html", stop_words: frozenset[str] = ALL_STOP_WORDS) -> DataFrame:
    """(page_id, url, text, n_chars) of every page. Pages are independent, so there is no shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                found = [main_text(x.decode("utf-8", "replace"), stop_words) if x else "" for x in part.column(2).cast(pa.binary()).to_pylist()]
                texts, sizes = pa.array(found, pa.string()), pa.array(map(len, found), pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), texts, sizes], ["page_id", "url", "text", "n_chars"])

    named = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), F.col(f"`{content}`").cast("binary").alias("html"))
    kinds = {f.name: f.dataType.simpleString() for f in named.schema}
    return named.mapInArrow(task, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")

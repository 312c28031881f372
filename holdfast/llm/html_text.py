"""Main text of web pages by consensus of each host's pages.

Every page is parsed into blocks of text, each with the containers around it. Blocks inside elements that are
menus, footers, sidebars, scripts and the like by their tag, or reader comments and adverts by name, are set aside.
Any other name, and a form, is evidence that what the element holds decides: a name that is made of such words only
stands against all but an element around nearly the whole of the page's text or around its article; a name with
other words in it against short texts and lists of links. Names of table parts, code and inline elements
say nothing where other text stands in the same block. The other blocks give their length, less for
links, to the containers around them, most to the nearest. A container is named by its path of tags and
classes, with digits made alike, and every page votes for the path of its best one. The path with most of a
host's votes wins, and all pages of the host are extracted again with it: the blocks inside containers of
that path. A page without such a container is extracted with its own best one, and so is a page on which that
holds less than half of the own best one's text, unless the pages that voted for the winner mostly have the
own best path too, so that it is a usual part beside the main text. From there the text goes on to containers
further out as long as what they add is headings or some prose with few links.

Containers of a page form a tree of paths, which is gone through once for the scores and once for the text, so the
time follows from the page's length at any depth.

Decided where the rules leave it open: hidden elements are no text; of a header inside an article or main element
the headings are kept, as the title; an open comment ends with the page. Nulls and edges: a null or empty page has
the empty text; a null address belongs to the host ''; pages with equal identifiers are each extracted; malformed
markup is read as far as it goes; extra columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Collection
from dataclasses import dataclass
from hashlib import blake2b
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import read_table, staged

# Names of elements, and words of names.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option "
    "p pre section summary table tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("article body center div main section td".split())
SET_ASIDE = frozenset(
    "aside audio button canvas datalist dialog embed footer head header iframe input label menu nav "
    "noframes noscript object option script select style svg template textarea title video".split()
)
# Words of class names, identifiers and roles. Made of these and general words only, a name is strong evidence.
SET_ASIDE_WORDS = frozenset(
    "ad ads advert advertisement advertisements adverts alert alerts banner breadcrumb breadcrumbs comment comments "
    "commentlist complementary contentinfo consent cookie cookies dialog disqus footer gdpr header login masthead menu "
    "menus modal nav navbar navigation newsletter notification pager pagination paywall popup promo promoted "
    "recommended replies reply respond sidebar signup social sponsor sponsored subscribe subscription toolbar "
    "topbar".split()
)
GENERAL_WORDS = frozenset(
    "area article badge bar block body bottom box btn button col column container content cta entry feed foot form frame "
    "global group head holder icon icons inline inner item items layout left link links list main middle mobile "
    "module msg panel page post posts primary right root row secondary section sections site slot sticky story sub text "
    "thread title top unit view widget widgets wrap wrapper".split()
)
# Words that also name parts of an article, alone as well.
DOUBTFUL_WORDS = frozenset("discussion form notice notices related search share sharing widget widgets".split())
# Names made of these, and general words, leave no doubt about a block, also where a section's identifier repeats
# its heading.
SURE_WORDS = frozenset(
    "ad ads advert advertisement advertisements adverts comment comments commentlist disqus replies respond".split()
)
# Elements that no name sets aside, and those whose names only count when they are all of a block.
NAMELESS = frozenset(
    "html body main article h1 h2 h3 h4 h5 h6 table thead tbody tfoot tr td th caption pre code kbd samp math".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# A doubtful element stays if links are less than one in so many of its characters, and it has so much text, or
# half of the page's, or is a section with a heading and text below. Under strong evidence it stays if it holds an
# article or main element, or all but one in so many characters of the page.
LINKED, LONG_TEXT, NEARLY_ALL = 4, 200, 10
# With one of these the name tells of a layout around such a part, as in has-sidebar.
AROUND_WORDS = frozenset("has layout no with without".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"},
          "tr": {"tr", "td", "th"}, "option": {"option"}}
CLOSING_STOPS = frozenset("ul ol dl table menu select article section div main body html".split())
STEP_UP = 0.95
BODY = "body"
FAVOURED, FAVOUR = frozenset({"article", "main"}), 1.2
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
DIGITS = re.compile(r"\d+")
UNFINISHED_TAG = re.compile(r"<[a-zA-Z/!?][^<>]*\Z")


class Place:
    """A path of containers, from the body to an innermost one: a node of the page's tree of paths."""

    __slots__ = ("parent", "label", "mark", "number", "inner")

    def __init__(self, parent: Place | None, label: str, number: int):
        self.parent, self.label, self.number = parent, label, number
        outer = parent.mark.to_bytes(8, signed=True) if parent else b""
        digest = blake2b(outer + label.encode("utf-8", "surrogatepass"), digest_size=8).digest()
        self.mark = int.from_bytes(digest, signed=True) if parent else 0
        self.inner: dict[str, Place] = {}

    def path(self) -> str:
        labels, place = [], self
        while place.parent:
            labels.append(place.label)
            place = place.parent
        return "".join(f"/{label}" for label in reversed(labels))


@dataclass(slots=True)
class Element:
    tag: str
    aside: bool
    in_link: bool
    place: Place
    doubt: int  # the number of the innermost doubtful element around, 0 for none
    block_doubt: int  # the same without inline elements
    heading: bool
    titled: bool  # inside an article or main element
    only_headings: bool  # inside a header there


@dataclass(slots=True)
class Block:
    place: Place
    text: str
    link_length: int
    doubt: int = 0
    heading: bool = False


@dataclass(slots=True)
class Doubt:
    """A doubtful element and what it holds outside of rejected ones."""

    around: int
    section: bool
    strong: bool
    length: int = 0
    link_length: int = 0
    heading_length: int = 0
    holds_article: bool = False

    def stays(self, total: int) -> bool:
        if self.strong:
            return self.holds_article or NEARLY_ALL * (total - self.length) <= total
        if self.link_length * LINKED >= self.length:
            return False
        under_heading = self.section and self.length > self.heading_length > 0
        return self.length >= LONG_TEXT or 2 * self.length >= total or under_heading


class PageParser(HTMLParser):
    """Collects a page's blocks outside of everything set aside."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        root = Place(None, "", 0)
        self.places = [root]
        self.open = [Element("", False, False, root, 0, 0, False, False, False)]
        self.open_tags: defaultdict[str, int] = defaultdict(int)
        self.blocks: list[Block] = []
        self.parts: list[str] = []
        self.link_length = 0
        self.started: Element | None = None
        self.doubt = 0
        self.doubts = [Doubt(0, False, False)]

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text and self.started:
            self.blocks.append(Block(self.started.place, text, self.link_length, self.doubt, self.started.heading))
        self.parts, self.link_length, self.started = [], 0, None

    def close_from(self, at: int) -> None:
        for element in self.open[at:]:
            self.open_tags[element.tag] -= 1
        del self.open[at:]

    def close_open(self, tags: set[str]) -> None:
        """Close an element that ends where another begins."""
        if all(self.open_tags[tag] == 0 for tag in tags):
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag in tags:
                self.close_from(at)
                return
            if self.open[at].tag in CLOSING_STOPS:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_block()
            self.close_open({"p"})
            if tag in CLOSES:
                self.close_open(CLOSES[tag])
        if tag in VOID:
            if tag == "br":
                self.parts.append(" ")
            return
        parent = self.open[-1]
        given = {name: value or "" for name, value in attrs}
        place = self.inner_place(parent.place, tag, given) if tag in CONTAINERS else parent.place
        titled = parent.titled or tag in FAVOURED
        heading = parent.heading or tag in HEADINGS
        only_headings = parent.only_headings
        aside, doubt, block_doubt = parent.aside, parent.doubt, parent.block_doubt
        if tag in FAVOURED:
            self.note_article(doubt)
        if tag == "header" and titled:
            only_headings = True
        elif tag in SET_ASIDE or "hidden" in given or given.get("aria-hidden") == "true":
            aside = True
        if not aside and tag not in NAMELESS:
            classes = given.get("class", "").split()
            section = tag == "section" or "section" in classes
            judged = self.judge_names(given, classes, section, tag in BLOCKS and tag not in ("p", "li", "dd", "dt"))
            if judged == "sure" and tag in BLOCKS:
                aside = True
            elif judged or tag == "form":
                self.doubts.append(Doubt(doubt, section, judged != "mixed"))
                doubt = len(self.doubts) - 1
                block_doubt = doubt if tag in BLOCKS else block_doubt
        self.open_tags[tag] += 1
        in_link = parent.in_link or tag == "a"
        self.open.append(Element(tag, aside, in_link, place, doubt, block_doubt, heading, titled, only_headings))

    def inner_place(self, outer: Place, tag: str, given: dict[str, str]) -> Place:
        classes = sorted(DIGITS.sub("#", c.lower()) for c in given.get("class", "").split())
        label = ".".join([tag, *classes])
        if label not in outer.inner:
            outer.inner[label] = Place(outer, label, len(self.places))
            self.places.append(outer.inner[label])
        return outer.inner[label]

    def note_article(self, doubt: int) -> None:
        while doubt and not self.doubts[doubt].holds_article:
            self.doubts[doubt].holds_article = True
            doubt = self.doubts[doubt].around

    @staticmethod
    def judge_names(given: dict[str, str], classes: list[str], section: bool, container: bool) -> str:
        """What the names say against the element: 'sure', 'strong', 'mixed' (which only counts for elements that may
        hold a part of a page) or nothing."""
        judged = ""
        for name in [*classes, given.get("role", ""), given.get("itemprop", ""), given.get("id", "")]:
            words = {word.lower() for word in WORD.findall(name)}
            found = words & SET_ASIDE_WORDS
            if words & AROUND_WORDS or not found and not words & DOUBTFUL_WORDS:
                continue
            own_section = section and name == given.get("id") and not found & SURE_WORDS
            alone = found and not own_section and words <= SET_ASIDE_WORDS | GENERAL_WORDS
            if alone and found & SURE_WORDS:
                return "sure"
            if alone:
                judged = "strong"
            elif container and not judged:
                judged = "mixed"
        return judged

    def kept_blocks(self) -> list[Block]:
        """The blocks outside of those doubtful elements that what they hold speaks against."""
        if len(self.doubts) == 1:
            return self.blocks
        for block in self.blocks:
            held = self.doubts[block.doubt]
            held.length += len(block.text)
            held.link_length += block.link_length
            held.heading_length += len(block.text) * block.heading
        total = sum(len(block.text) for block in self.blocks)
        rejected = set()
        for number in range(len(self.doubts) - 1, 0, -1):  # the inner ones come later
            held = self.doubts[number]
            if held.stays(total):
                around = self.doubts[held.around]
                around.length += held.length
                around.link_length += held.link_length
                around.heading_length += held.heading_length
            else:
                rejected.add(number)
                total -= held.length
        for number in range(1, len(self.doubts)):
            if self.doubts[number].around in rejected:
                rejected.add(number)
        return [block for block in self.blocks if block.doubt not in rejected]

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCKS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        is_block = tag in BLOCKS
        if is_block:
            self.end_block()
        if not self.open_tags[tag]:
            return
        for at in range(len(self.open) - 1, 0, -1):
            if self.open[at].tag == tag:
                self.close_from(at)
                return
            if not is_block and self.open[at].tag in BLOCKS:
                return  # an inline element closed across a block

    def handle_data(self, data: str) -> None:
        here = self.open[-1]
        if here.aside or here.only_headings and not here.heading:
            return
        if not data.isspace():
            if self.started is None:
                self.started, self.doubt = here, here.doubt
            elif self.doubt != here.doubt:
                self.doubt = self.started.block_doubt  # the block has text outside of an inline element
        self.parts.append(data)
        if here.in_link:
            self.link_length += len(data.strip())


@dataclass(slots=True)
class Page:
    """The blocks of a page and the tree of its containers' paths; outer ones come first."""

    blocks: list[Block]
    places: list[Place]

    def scores(self) -> list[float]:
        """How much of the page's text each path holds, links counting against it, by number of the path."""
        held = [0.0] * len(self.places)
        for block in self.blocks:
            held[block.place.number] += max(0, len(block.text) - 2 * block.link_length)
        for place in reversed(self.places[1:]):
            held[place.parent.number] += STEP_UP * held[place.number]
        return [h * (FAVOUR if p.label.partition(".")[0] in FAVOURED else 1.0) for h, p in zip(held, self.places, strict=True)]

    def with_text(self) -> set[int]:
        """The numbers of the paths that hold a block, without the page's own."""
        found = set()
        for block in self.blocks:
            place = block.place
            while place.parent and place.number not in found:
                found.add(place.number)
                place = place.parent
        return found

    def best(self) -> Place | None:
        held, scores = self.with_text(), self.scores()
        if not held:
            return None
        most = max(scores[n] for n in held)
        return max((self.places[n] for n in held if scores[n] == most), key=Place.path)

    def inside(self, place: Place) -> list[bool]:
        """By number of a path: whether it is that of `place` or goes on from it."""
        found = [False] * len(self.places)
        found[place.number] = True
        for each in self.places[place.number + 1 :]:
            found[each.number] = found[each.parent.number]
        return found

    def mass(self, place: Place) -> int:
        inside = self.inside(place)
        return sum(max(0, len(b.text) - 2 * b.link_length) for b in self.blocks if inside[b.place.number])

    def climbed(self, place: Place) -> Place:
        """The outermost container around `place` that adds headings or less prose than it has, few of it links.

        The body holds everything, so only headings lead up to it.
        """
        chain = [place]
        while chain[-1].parent:
            chain.append(chain[-1].parent)
        chain = chain[-2::-1]  # outermost first, without the page itself
        level = [-1] * len(self.places)  # of the innermost place of the chain that is around or the same
        for at, each in enumerate(chain):
            level[each.number] = at
        for each in self.places[1:]:
            if level[each.number] < 0:
                level[each.number] = level[each.parent.number]
        beside: list[list[Block]] = [[] for _ in chain]
        for block in self.blocks:
            if level[block.place.number] >= 0:
                beside[level[block.place.number]].append(block)
        chosen, inside = place, sum(len(b.text) for b in beside[-1])
        for at in range(len(chain) - 2, -1, -1):
            outside = beside[at]
            prose = [b for b in outside if not b.heading]
            length = sum(len(b.text) for b in prose)
            body = at == 0 and chain[0].label.partition(".")[0] == BODY
            if prose and (body or length >= inside or sum(b.link_length for b in prose) * LINKED >= length):
                break
            if any(b.link_length * LINKED >= len(b.text) for b in outside if b.heading):
                break  # headings that are links tell of other articles
            if outside:
                chosen = chain[at]
            inside += sum(len(b.text) for b in outside)
        return chosen


def without_open_comment(html: str) -> str:
    """The page up to a comment that never ends; a script may hold such a mark."""
    at = html.rfind("<!--")
    if at < 0 or html.find("-->", at) >= 0:
        return html
    before = html[:at].lower()
    if any(before.rfind(f"<{tag}") > before.rfind(f"</{tag}") for tag in ("script", "style", "textarea", "title")):
        return html
    return html[:at]


def page_of(html: str | None) -> Page:
    parser = PageParser()
    parser.feed(UNFINISHED_TAG.sub("", without_open_comment(html or "")))
    parser.close()
    parser.end_block()
    return Page(parser.kept_blocks(), parser.places)


def main_text(html: str | None, winner: int | None, usual: Collection[int] = ()) -> tuple[str, str]:
    """The text inside containers of the path chosen, and that path. `winner` is the mark of the path that won,
    `usual` are the marks of the paths that the pages that voted for it have."""
    page = page_of(html)
    own = page.best()
    if own is None:
        return "\n".join(b.text for b in page.blocks), ""
    chosen = own
    held = page.with_text()
    won = next((p for p in page.places if p.mark == winner and p.number in held), None) if winner else None
    if won and (2 * page.mass(won) >= page.mass(own) or own.mark in usual):
        chosen = won
    chosen = page.climbed(chosen)
    inside = page.inside(chosen)
    return "\n".join(b.text for b in page.blocks if inside[b.place.number]), chosen.path()


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vote_of(html: Column) -> Column:
    """The path of each page's best container, its mark, and the marks of all the page's containers."""

    def vote(html: str | None) -> tuple[str, int, list[int]]:
        page = page_of(html)
        best = page.best()
        if best is None:
            return "", 0, []
        return best.path(), best.mark, sorted({page.places[n].mark for n in page.with_text()})

    @F.pandas_udf("path string, mark long, marks array<long>")
    def votes(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([vote(page) for page in pages], columns=["path", "mark", "marks"])

    return votes(html)


def extracted(html: Column, winner: Column, usual: Column) -> Column:
    @F.pandas_udf("text string, path string")
    def texts(pages: pd.Series, winners: pd.Series, usuals: pd.Series) -> pd.DataFrame:
        rows = zip(pages, winners, usuals, strict=True)
        found = [main_text(h, None if w is None else int(w[0]), () if u is None else u) for h, w, u in rows]
        return pd.DataFrame(found, columns=["text", "path"])

    # as an array, for a long that may be null would reach pandas as a float
    return texts(html, F.when(winner.isNotNull(), F.array(winner)), usual)


def winning_paths(host: Column, html: Column, pages: DataFrame) -> DataFrame:
    """(host, winner, usual) by the votes of all pages: the mark of the winning path, and those of the paths that at
    least half of the winner's voters have, so at most twice as many as such a page has on average."""
    votes = pages.select(host.alias("host"), vote_of(html).alias("vote")).select("host", "vote.*")
    # pages without a container have no marks and so no rows
    found = votes.select("host", "path", "mark", F.explode("marks").alias("other"))
    named = F.max(F.when(F.col("other") == F.col("mark"), F.col("path"))).alias("path")
    counted = staged(found.groupBy("host", "mark", "other").agg(F.count(F.lit(1)).alias("count"), named))
    best = F.max(F.struct("count", "path", "mark")).alias("best")  # a page always has the container it votes for
    winners = counted.where("other = mark").groupBy("host").agg(best)
    winners = winners.select("host", "best.mark", F.col("best.count").alias("voters"))
    shared = counted.join(winners, ["host", "mark"]).where("2 * count >= voters")
    return shared.groupBy("host", F.col("mark").alias("winner")).agg(F.collect_list("other").alias("usual"))


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text, n_chars, host, path (the container path used)."""
    url, html = F.col(f"`{url_col}`"), F.col(f"`{html_col}`")
    winners = staged(winning_paths(host_of(url), html, pages))
    rows = pages.select(F.col(f"`{id_col}`").alias("page_id"), url.alias("url"), html.alias("html"))
    rows = rows.withColumn("host", host_of(F.col("url"))).join(winners, "host", "left")
    done = rows.select("page_id", "url", "host", extracted(F.col("html"), F.col("winner"), F.col("usual")).alias("found"))
    return done.select(
        "page_id", "url", "found.text", F.length("found.text").cast("long").alias("n_chars"), "host", "found.path"
    )


def query(spark, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))

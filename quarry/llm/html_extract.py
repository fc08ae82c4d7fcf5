"""Main text of HTML pages by consensus host paths.

Each page's containers are scored by how much of its running text, and how little of its links and
boilerplate, they hold. The scores are votes for generalised tag-class paths, summed per host in Spark;
then each page is parsed again and read from the containers on its host's winning path. Unless HTML names
the winner as the main text, good blocks outside it (titles, intros) are read too if their own paths have
votes enough. A page without the winning path, or without a host, is read from its own best container.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import broadcast_if_small, by_bytes, saved

# Elements by their role in HTML, and words that name boilerplate in class, id and role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rb rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr".split())
UNSEEN = frozenset("script style noscript template title meta link svg canvas iframe object embed audio video map math "
                   "datalist".split())
BOILERPLATE_TAGS = frozenset("nav header footer aside form menu dialog button select textarea input label fieldset".split())
CONTAINERS = frozenset("html body main article section div td center blockquote".split())
CLOSED_BY_SIBLING = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
                     "th": {"td", "th"}, "option": {"option"}}
BOILERPLATE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist "
    "complementary consent contentinfo cookie cookies copyright dialog disclaimer discussion disqus dropdown feedback "
    "footer form gdpr header login masthead menu menubar modal nav navbar navigation newsletter notice notices notification "
    "outbrain overlay pager pagination paywall popup promo promoted promotion recommendations recommended related replies "
    "respond search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription taboola tags "
    "toc toolbar topbar tracking widget widgets".split())
# Of these, words that name what never is the layout around a text, alone or before a word for a part, and words that
# are also used for text itself.
NEVER_LAYOUT = frozenset("ad adbox ads advert advertisement advertising adverts comment commentlist comments discussion disqus footer "
                         "menu menubar nav navbar navigation replies respond sidenav".split())
PARTS = frozenset("area block body box container content inner item items list main section thread wrap wrapper".split())
SOFT_WORDS = frozenset("related search share sharing social tags".split())
# Elements that no name makes boilerplate, and boilerplate elements that may stand around the whole page.
NEVER_NAMED, AROUND = frozenset("html body main article".split()), frozenset("form fieldset".split())
# Why an element counts as boilerplate; by its name or as a form it does not if it holds the page's text, softly by its
# name not if it is running text with few links.
SOFTLY, BY_NAME, AS_FORM, ALWAYS = 1, 2, 3, 4
# A running sentence: its least length, and the characters it may end with.
SENTENCE, ENDS = 80, ".!?\u2026\"'\u201d\u2019)"
# Elements that do not end the text block they stand in.
WITHIN = INLINE | UNSEEN
NEGATED = frozenset("has with no without".split())
# Votes are whole numbers, so that sums do not depend on their order.
UNIT = 1_000_000
# Blocks outside the winner are read if their path has at least this part of the winner's votes.
OUTSIDE = 500


class Page(HTMLParser):
    """Elements and text blocks of one page; elements are numbers, their features parallel lists."""

    def __init__(self, html: str, names: bool = True):
        super().__init__(convert_charrefs=True)
        self.names, self.mark = names, [0]
        self.judged: list[tuple[int, str, int, bool]] | None = None
        self.tag, self.parent, self.path, self.depth, self.bad, self.seen = ["html"], [-1], [0], [0], [False], [True]
        self.named: set[int] = set()  # paths that HTML itself names as the main text
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.lists: dict[int, list[int]] = {}  # of a list: links, characters in links, characters
        self.at, self.links, self.text, self.linked = 0, 0, [], 0
        self.feed(html)
        self.close()
        self.flush()
        self.settle()

    def settle(self) -> None:
        """Which elements are boilerplate. A mark on one that holds more than half of the page's running text, and
        over three times what is outside all marks, names the layout around the main text and is dropped. So is a
        soft mark on an element of few links that is a sentence of the article or holds a third of the running text.
        """
        held, tied, marked = [0] * len(self.tag), [0] * len(self.tag), [False] * len(self.tag)
        within, sentence = [False] * len(self.tag), [False] * len(self.tag)
        for element, text, linked in self.blocks:
            held[element] += len(text) - linked
            tied[element] += linked
            sentence[element] = sentence[element] or (len(text) >= SENTENCE and text[-1] in ENDS)
        for e in range(1, len(held)):
            marked[e] = self.mark[e] > 0 or marked[self.parent[e]]
        total, free = sum(held), sum(n for n, m in zip(held, marked, strict=True) if not m)
        for e in range(len(held) - 1, 0, -1):
            held[self.parent[e]] += held[e]
            tied[self.parent[e]] += tied[e]
        for e in range(1, len(held)):
            within[e] = within[self.parent[e]] or self.tag[e] in ("article", "main")
            layout = self.mark[e] < ALWAYS and 2 * held[e] > total and held[e] > 3 * free
            running = self.mark[e] == SOFTLY and held[e] > 4 * tied[e] and (
                3 * held[e] >= total or (self.tag[e] == "p" and sentence[e] and within[e]))
            self.bad[e] = self.bad[self.parent[e]] or (self.mark[e] > 0 and not layout and not running)

    def flush(self) -> None:
        text = " ".join("".join(self.text).split())
        if text:
            self.blocks.append((self.at, text, min(self.linked, len(text))))
        self.text, self.linked = [], 0

    def leave(self, element: int) -> None:
        """Close everything up to and including the element."""
        while True:
            at, self.at = self.at, self.parent[self.at]
            self.links -= self.tag[at] == "a"
            if at == element:
                return

    def open_among(self, tags: set[str] | frozenset[str], stop: frozenset[str]) -> int:
        """The nearest open element with one of the tags, 0 if a stop element or the root comes first."""
        at = self.at
        while at and self.tag[at] not in tags:
            if self.tag[at] in stop:
                return 0
            at = self.parent[at]
        return at

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        block = tag not in WITHIN
        if block:
            self.flush()
            if tag not in VOID and (p := self.open_among({"p"}, CONTAINERS)):
                self.leave(p)
            if (twins := CLOSED_BY_SIBLING.get(tag)) and (twin := self.open_among(twins, frozenset({"ul", "ol", "dl", "table"}))):
                self.leave(twin)
        if tag in VOID:
            return
        if tag == "a" and self.links and (a := self.open_among({"a"}, CONTAINERS)):
            self.leave(a)
        names = {k: v or "" for k, v in attrs}
        label = sorted({re.sub(r"\d+", "#", x) for x in names.get("class", "").lower().split()})
        if name := names.get("id", "").lower():
            label.append("#" + re.sub(r"\d+", "#", name))
        here, new = self.at, len(self.tag)
        self.tag.append(tag)
        self.parent.append(here)
        self.depth.append(self.depth[here] + block)
        step = f"{self.path[here]}/{tag}.{'.'.join(label)}"
        self.path.append(xxhash.xxh64_intdigest(step) >> 1 if block else self.path[here])
        hidden = "hidden" in names or names.get("aria-hidden") == "true" or "display:none" in names.get("style", "").replace(" ", "")
        bad = AS_FORM if tag in AROUND and not hidden else ALWAYS if hidden or tag in BOILERPLATE_TAGS else 0
        if not bad and self.names and tag not in NEVER_NAMED:
            bad = self.mark_by_name(names)
        self.mark.append(bad)
        self.bad.append(False)
        if tag in ("article", "main") or names.get("role") == "main" or names.get("itemprop") == "articleBody":
            self.named.add(self.path[new])
        self.seen.append(self.seen[here] and tag not in UNSEEN and (block or not bad))
        self.at = new
        self.links += tag == "a"
        if tag in ("ul", "ol"):
            self.lists[new] = [0, 0, 0]

    @staticmethod
    def mark_by_name(names: dict[str, str]) -> int:
        """What the class, id and role of an element say of it; 0 for nothing."""
        mark = 0
        for name in " ".join((names.get("class", ""), names.get("id", ""), names.get("role", ""))).lower().split():
            words = [w for w in re.split(r"[^a-z]+", name) if w]
            for i, w in enumerate(words):
                if w in BOILERPLATE_WORDS and (i == 0 or words[i - 1] not in NEGATED):
                    never = w in NEVER_LAYOUT and PARTS.issuperset(words[i + 1:])
                    mark = max(mark, ALWAYS if never else SOFTLY if w in SOFT_WORDS else BY_NAME)
        return mark

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        inline = tag in WITHIN
        if not inline:
            self.flush()
        at = self.at
        while at and self.tag[at] != tag:
            if inline and self.tag[at] not in WITHIN:
                return
            at = self.parent[at]
        if at:
            self.leave(at)

    def handle_data(self, data: str) -> None:
        if self.seen[self.at]:
            self.text.append(data)
            self.linked += len(data) if self.links else 0

    def menus(self) -> set[int]:
        """Lists of three links or more that hold little else."""
        for element, text, linked in self.blocks:
            while element >= 0:
                if element in self.lists:
                    total = self.lists[element]
                    total[0], total[1], total[2] = total[0] + (linked > 0), total[1] + linked, total[2] + len(text)
                    break
                element = self.parent[element]
        return {e for e, (n, linked, total) in self.lists.items() if n >= 3 and linked > 0.8 * total}

    def read(self) -> list[tuple[int, str, int, bool]]:
        """Blocks as (element, text, characters in links, whether boilerplate)."""
        if self.judged is not None:
            return self.judged
        menus, kind = self.menus(), {}

        def boilerplate(element: int) -> bool:
            way = []
            while element >= 0 and element not in kind:
                way.append(element)
                if element in menus:
                    break
                element = self.parent[element]
            found = element in menus or (element >= 0 and kind.get(element, False))
            for e in way:
                kind[e] = found
            return found

        self.judged = [(e, text, linked, self.bad[e] or boilerplate(e)) for e, text, linked in self.blocks]
        return self.judged

    def own(self, element: int) -> int:
        """The path of a block by itself: not that of the container it may stand in directly."""
        return xxhash.xxh64_intdigest(f"{self.path[element]}#") >> 1

    @staticmethod
    def is_good(text: str, linked: int, boilerplate: bool) -> bool:
        return not boilerplate and 2 * linked <= len(text)

    def votes(self) -> dict[tuple[int, int, bool], int]:
        """(path, depth, whether named) of the containers that hold more of the good than of the bad text, with
        their surplus over all text of the page; at depth -1 the paths of good blocks, with their share.

        The surplus of an element that HTML names as the main text counts a quarter more.
        """
        good, bad, blocks, total = Counter(), Counter(), Counter(), 0
        for element, text, linked, boilerplate in self.read():
            total += len(text)
            fine = self.is_good(text, linked, boilerplate)
            if fine:
                blocks[self.own(element), -1, False] += len(text)
            ways = set()
            while element >= 0:
                if self.tag[element] in CONTAINERS and not self.bad[element]:
                    ways.add((self.path[element], self.depth[element], self.path[element] in self.named))
                element = self.parent[element]
            for way in ways:
                (good if fine else bad)[way] += len(text)
        if not good:
            return {}
        surplus = {w: UNIT * (n - bad[w]) // total for w, n in good.items()}
        surplus = {w: s * 5 // 4 if w[2] else s for w, s in surplus.items()}
        won = {w: s for w, s in surplus.items() if s > 0} or {(0, 0, False): 1}
        return won | {w: UNIT * n // total for w, n in blocks.items()}

    def winners(self) -> tuple[int, list[int]]:
        """The page's own winning path, and the paths of blocks that are read besides."""
        votes = self.votes()
        inner = [w for w in votes if w[1] >= 0]
        if not inner:
            return 0, []
        best = max(inner, key=lambda w: (votes[w], w[1], w[0]))
        return best[0], [] if best[2] else [w[0] for w, n in votes.items() if w[1] < 0 and n * OUTSIDE >= votes[best]]

    def main_text(self, path: int | None, outside: list[int] | None = None) -> str:
        """Blocks outside boilerplate in the containers on the path, or on the page's own best one, and good ones ``outside``."""
        for way in (path, None):
            if way is None:
                way, outside = self.winners()
            elif way not in self.path:
                continue
            besides = set(outside or ())
            inside = [p == way for p in self.path]
            for e in range(1, len(inside)):
                inside[e] = inside[e] or inside[self.parent[e]]
            texts = [text for e, text, linked, boilerplate in self.read() if not boilerplate and (
                inside[e] or (besides and self.is_good(text, linked, boilerplate) and self.own(e) in besides))]
            if texts:
                return " ".join(texts)
        return ""


def page_of(html: str) -> Page:
    """The page, read without the rule of names where that leaves no text."""
    page = Page(html)
    return page if any(not boilerplate for *_, boilerplate in page.read()) else Page(html, names=False)


def host_of(url: str | None) -> str | None:
    """Host of an absolute URL in lower case, without user, port and a leading ``www.``; else None."""
    found = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", url or "")
    return found[1].lower().removeprefix("www.") if found else None


def host_votes(df: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """``host, path, depth, named, votes`` summed over all pages with a host."""
    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def rows() -> pa.RecordBatch:
            keys, n = list(total), list(total.values())
            total.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.bool_()))]
                + [pa.array(n, pa.int64())], names=["host", "path", "depth", "named", "votes"])

        for part in (part for batch in batches for part in by_bytes(batch, "h")):
            for url, html in zip(part.column("u").to_pylist(), part.column("h").to_pylist(), strict=True):
                if html and (host := host_of(url)):
                    for (path, depth, named), n in page_of(html).votes().items():
                        total[host, path, depth, named] += n
                if len(total) > 50_000:
                    yield rows()
        yield rows()

    return (df.select(df[url_col].alias("u"), df[html_col].alias("h"))
            .mapInArrow(kernel, "host string, path long, depth int, named boolean, votes long")
            .groupBy("host", "path", "depth").agg(F.sum("votes").alias("votes"), F.max("named").alias("named")))


def extract(df: DataFrame, html_col: str = "html", url_col: str = "url", keep: tuple[str, ...] = ("page_id",),
            broadcast_bytes: int = 16 << 20) -> DataFrame:
    """``keep`` columns, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    A null, empty or textless page has the text '' (0). Pages are read whole; a page without a host (null
    or relative url) is read by itself. Repeated pages vote and are read each time. Votes tie to the
    deeper path, then the greater path number. Further columns are not read; an empty table gives an
    empty result. The winners are broadcast only if they are known to take at most ``broadcast_bytes``;
    beyond that they are joined by host, where adaptive execution can split a large host.
    """
    keep = list(keep)
    source = df.select(*keep, df[url_col].alias("__url"), df[html_col].alias("__html"))
    votes = saved(host_votes(source, "__url", "__html"))
    best = votes.where("depth >= 0").groupBy("host").agg(F.max(F.struct("votes", "depth", "path", "named")).alias("best"))
    # every page's block paths share its one whole vote: a host has at most a few times OUTSIDE paths with votes enough
    outside = (votes.where("depth < 0").join(best.where("not best.named"), "host").where(F.col("votes") * OUTSIDE >= F.col("best.votes"))
               .groupBy("host").agg(F.sort_array(F.collect_list("path")).alias("__outside")))
    winners = saved(best.select("host", F.col("best.path").alias("__path")).join(outside, "host", "left"))
    lists = winners.agg(F.sum(F.size(F.coalesce("__outside", F.array().cast("array<bigint>"))))).first()[0] or 0
    winners = broadcast_if_small(winners, ("host",), broadcast_bytes - 8 * lists)
    host = F.regexp_replace(F.lower(F.regexp_extract("__url", r"^\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1)),
                            r"^www\.", "")
    joined = source.withColumn("__host", host).join(winners, F.col("__host") == winners["host"], "left")

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in by_bytes(batch, "__html"):
                texts = [page_of(html).main_text(path, outside) if html else "" for html, path, outside in
                         zip(*(part.column(c).to_pylist() for c in ("__html", "__path", "__outside")), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in keep), part.column("__url"), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "url", "text", "n_chars"])

    schema = "".join(f"`{c}` {source.schema[c].dataType.simpleString()}, " for c in keep)
    return (joined.select(*keep, "__url", "__html", "__path", "__outside")
            .mapInArrow(kernel, f"{schema}url string, text string, n_chars long"))

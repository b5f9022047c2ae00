"""HTML extraction: page templates deduced from equivalence classes of tokens.

Tokens are start tags with their place in the structure, and blocks of text. Tokens that
occur equally often on every page of a host share an occurrence vector and form an
equivalence class; classes of two or more tokens that reach at least half of the host's
pages are valid and make up its template, nested by place. What the template leaves open
are slots: blocks of text that belong to a valid class are template, all others are fill.
The main slot is the innermost place of a class that holds ``MAIN_SHARE`` of the host's
fill, places counting all that lies below them.

A page's main text is all of its article (or main) element; a page with neither gives the
fill of its host's main slot. Menus, headers, footers, sidebars, notices, adverts, forms and
comments are left out, by tags and names: outside an article a part of a class name tells,
inside one only a whole name.

Every page is parsed once to a small row of token digests, and once more for its text; the
pages themselves are never shuffled for the templates. An occurrence vector is never
gathered: it is compared by (pages, occurrences, sum of a hash of page and count), which
combine before the shuffle. So a host with most of the pages is no group in any task.
Hosts with fewer than ``LEAST_PAGES`` different pages show no classes of their own; their
pages without an article use the classes of all pages. Templates come back by a join on
host and a salt.

Nulls and odd input: a null or empty page has empty text and 0 characters. A null or
unreadable url counts to the host ''. Repeated rows are extracted each. In occurrence vectors
pages of a host with the same set of content blocks (those of the article, or without one all
that are not left out) count as one page, so copies of an article make no template of it.
Other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewatch.session import written

#: Different pages from which a host shows classes of its own.
LEAST_PAGES = 8
#: Part of the fill that the main slot holds.
MAIN_SHARE = 0.75
SALTS = 16
POOLED = "*"

BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noframes ol optgroup option p pre "
    "search section summary table tbody td tfoot th thead title tr ul".split()
)
#: Elements that make up places; the others neither nest nor end anything here.
PLACE_TAGS = BLOCK_TAGS - set("p h1 h2 h3 h4 h5 h6 hr li dt dd option optgroup".split()) | {
    "script", "style", "noscript", "template", "iframe", "object", "button", "select", "textarea", "svg", "label", "video", "audio", "canvas",
}
LEFT_OUT_TAGS = frozenset(
    "nav footer aside form script style noscript template iframe object button select textarea svg head menu dialog "
    "label video audio canvas frameset noframes search".split()
)
LEFT_OUT_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disclaimer disqus footer gdpr menu modal nav navbar navigation newsletter notice notices overlay "
    "popup promo promoted promotion related replies reply respond share sharing sidebar signup social sponsor sponsored "
    "subscribe subscription toolbar widget widgets".split()
)
HEADER_NAMES = frozenset({"header", "masthead", "topbar"})
LEFT_OUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
WHOLE = frozenset({"html", "body", "main", "article"})


class _Page(HTMLParser):
    """Blocks of a page as (place, text, in the article, left out), and its places."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, str, bool, bool]] = []  # tag, place, in article, left out
        self.blocks: list[tuple[str, str, bool, bool]] = []
        self.places: Counter[str] = Counter()
        self.text: list[str] = []

    def _flush(self) -> None:
        text = " ".join("".join(self.text).split())
        self.text.clear()
        if text:
            _, place, article, out = self.stack[-1] if self.stack else ("", "", False, False)
            self.blocks.append((place, text, article, out))

    def handle_starttag(self, tag, attrs):
        if tag == "br":
            self.text.append(" ")
        if tag in BLOCK_TAGS:
            self._flush()
        if tag not in PLACE_TAGS:
            return
        if tag not in BLOCK_TAGS:
            self._flush()
        about = {k: (v or "") for k, v in attrs}
        own = f"{about.get('class', '')} {about.get('id', '')}"
        names = re.findall("[a-z0-9]+", re.sub("([a-z])([A-Z])", r"\1 \2", own).lower())
        _, above, article, out = self.stack[-1] if self.stack else ("", "", False, False)
        telling = own.lower().split() if article else names
        if tag in ("article", "main"):
            article = True
        if tag in WHOLE:
            hidden = False
        else:
            hidden = (
                (tag in LEFT_OUT_TAGS and not (article and tag == "label"))
                or not LEFT_OUT_NAMES.isdisjoint(telling)
                or (not article and (tag == "header" or not HEADER_NAMES.isdisjoint(names)))
                or about.get("role", "").lower() in LEFT_OUT_ROLES
                or "hidden" in about
                or "display:none" in about.get("style", "").replace(" ", "").lower()
            )
        if tag == "article" and not LEFT_OUT_NAMES.isdisjoint(names):
            hidden = True
        place = f"{above}/{tag}" + "".join(f".{n}" for n in names if not n.isdigit())
        self.places[place] += 1
        self.stack.append((tag, place, article, out or hidden))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag in PLACE_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCK_TAGS or tag in PLACE_TAGS:
            self._flush()
        if tag in PLACE_TAGS:
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i][0] == tag:
                    del self.stack[i:]
                    break

    def handle_data(self, data):
        self.text.append(data)


def parsed(html: str | None) -> _Page:
    page = _Page()
    page.feed(html or "")
    page.close()
    page._flush()
    return page


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _digest(text: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(text.encode("utf-8", "surrogatepass"))


def _around(place: str) -> list[str]:
    """The place and all places it lies in, innermost first."""
    parts = place.split("/")
    return ["/".join(parts[:n]) for n in range(len(parts), 1, -1)]


def _token(kind: str, text: str) -> int:
    return _digest(f"{kind}{text}")


_ROW = "host string, content long, key long, tokens array<struct<token:long,depth:int,n:int,words:int>>"


def _compact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A small row for each page: digests of its content and tokens, with occurrences and words below each place."""
    kind = pa.list_(pa.struct([("token", pa.int64()), ("depth", pa.int32()), ("n", pa.int32()), ("words", pa.int32())]))

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    for batch in batches:
        hosts, contents, keys, tokens = [], [], [], []
        for name, key, html in zip(*(batch.column(c).to_pylist() for c in ("host", "key", "html")), strict=True):
            page = parsed(html)
            article = any(inside for _, _, inside, _ in page.blocks)
            texts = {text for _, text, inside, out in page.blocks if not out and (inside or not article)}
            times = Counter(text for _, text, _, _ in page.blocks)
            words: Counter[str] = Counter()
            fill: Counter[str] = Counter()
            for place, text, _, out in page.blocks:
                if not out:
                    n = text.count(" ") + 1
                    fill[text] += n
                    for above in _around(place):
                        words[above] += n
            row = [(_token("<", p), p.count("/"), n, words[p]) for p, n in page.places.items()]
            row += [(_token("=", t), 0, n, fill[t]) for t, n in times.items()]
            row.append((_token("", ""), -1, 1, sum(fill.values())))
            hosts.append(name)
            contents.append(signed(_digest("\n".join(sorted(texts)))))
            keys.append(key)
            tokens.append([{"token": signed(t), "depth": d, "n": n, "words": w} for t, d, n, w in row])
        yield pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(contents, pa.int64()), pa.array(keys, pa.int64()), pa.array(tokens, kind)],
            ["host", "content", "key", "tokens"],
        )


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, token, depth, pages, times, vector, words): how often each token occurs, by host and over all pages.

    Of the pages of a host with one content, and of all pages with it, one counts.
    """
    rows = pages.select(host(F.col("url")).alias("host"), F.xxhash64("url", "html").alias("key"), "html")
    made = rows.mapInArrow(_compact, _ROW).withColumn("id", F.monotonically_increasing_id())
    made = written(made, "compact-pages")
    ids = made.select("id", "host", "content")
    of_host = ids.groupBy("host", "content").agg(F.min("id").alias("id"))
    of_all = ids.groupBy("content").agg(F.min("id").alias("id")).select("id", F.lit(True).alias("pooled"))
    voters = written(of_host.select("id").join(of_all, "id", "left"), "voters")
    groups = F.when(F.col("pooled"), F.array("host", F.lit(POOLED))).otherwise(F.array("host"))
    chosen = made.join(voters, "id").select("key", F.explode(groups).alias("host"), "tokens")
    each = chosen.select("host", "key", F.inline("tokens"))
    mark = F.shiftrightunsigned(F.xxhash64("key", "n"), 24)  # 40 bits, so that sums of many pages fit
    return each.groupBy("host", "token", "depth").agg(
        F.count("*").alias("pages"), F.sum("n").alias("times"), F.sum(mark).alias("vector"), F.sum("words").alias("words")
    )


def templates(pages: DataFrame) -> DataFrame:
    """(host, blocks, main): digests of the template's text blocks and the main slot's place, by host."""
    counts = written(occurrences(pages), "occurrences")
    totals = counts.where("depth = -1").select("host", F.col("pages").alias("all_pages"), F.col("words").alias("all_words"))
    totals = totals.where((F.col("all_pages") >= LEAST_PAGES) | (F.col("host") == POOLED))
    common = written(
        counts.where("depth >= 0").join(totals, "host").where(2 * F.col("pages") >= F.greatest("all_pages", F.lit(LEAST_PAGES))),
        "common-tokens",
    )
    classes = common.groupBy("host", "pages", "times", "vector").agg(F.count("*").alias("size")).where("size >= 2")
    valid = common.join(classes, ["host", "pages", "times", "vector"])
    block = F.col("depth") == 0
    fixed = valid.where(block).groupBy("host").agg(F.collect_list("token").alias("blocks"), F.sum("words").alias("fixed_words"))
    slots = valid.where(~block).join(fixed.select("host", "fixed_words"), "host", "left")
    fill = F.col("all_words") - F.coalesce("fixed_words", F.lit(0))
    main = slots.where(F.col("words") >= MAIN_SHARE * fill).groupBy("host").agg(
        F.max(F.struct("depth", "words", "token")).getField("token").alias("main")
    )
    found = totals.select("host").join(fixed, "host", "left").join(main, "host", "left")
    return written(found.select("host", F.coalesce("blocks", F.expr("CAST(array() AS array<long>)")).alias("blocks"), "main"), "templates")


def main_text(html: str | None, blocks: frozenset[int], main: int | None) -> str:
    page = parsed(html)
    if any(article for _, _, article, _ in page.blocks):
        return "\n".join(text for _, text, article, out in page.blocks if article and not out)

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    fill = [(place, text) for place, text, _, out in page.blocks if not out and signed(_token("=", text)) not in blocks]
    inside = [text for place, text in fill if any(signed(_token("<", above)) == main for above in _around(place))]
    return "\n".join(inside or [text for _, text in fill])


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    by_host = templates(pages)
    pooled = by_host.where(F.col("host") == POOLED).first()
    shared = (frozenset(pooled.blocks), pooled.main) if pooled else (frozenset(), None)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    spread = by_host.select("host", salts.alias("salt"), "blocks", "main")
    rows = pages.select("page_id", "url", "html", host(F.col("url")).alias("host"), F.pmod(F.xxhash64("url", "html"), F.lit(SALTS)).cast("int").alias("salt"))
    known = rows.join(spread, ["host", "salt"], "left").select("page_id", "url", "html", "blocks", "main")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, blocks, main in zip(*(batch.column(c).to_pylist() for c in ("html", "blocks", "main")), strict=True):
                own = shared if blocks is None else (frozenset(blocks), main)
                texts.append(main_text(html, *own))
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(texts, pa.string()),
                    "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                }
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return known.mapInArrow(extract, f"page_id {kind}, url string, text string, n_chars long")

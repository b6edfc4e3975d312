"""Main text of web pages: page structure, and a suffix array of each host for what it leaves open.

A page is read as a stream of tags and text and cut into blocks. What the elements name
(article and main; navigation, footers, forms, ...) is decided by the elements. Repetition alone
could not: copies of an article on one host are article text, and the menu of a host with one
page repeats nowhere. Names in a class or id (adverts, comments, sidebars, ...) are hints:

* a hint counts if the whole name says so (``ad-box``, ``comment-list``), not if a word of it
  does (``has-sidebar``, ``share-price-table``);
* it never removes a main element, nor the main part inside the element it is on: an article in
  or with a hint is taken where the page has no other main part;
* where hints leave a page without any text, the blocks they are on are judged by their host.

Where a page has no main part, its blocks are judged by their host: the token streams of all pages
of a host (words, and a token for the container of each block, without the main parts) are the
host's text. A string of ``MIN_TOKENS`` tokens that occurs on two distinct pages is boilerplate;
strings are named by prefix doubling (1, 2, 4, ... tokens, then two overlapping names), and
counted by host and name. Tokens that such a string covers are removed, and the unique runs are
kept.
"""

from __future__ import annotations

import hashlib
import html
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changecapture.llm.common import written

MIN_TOKENS = 8
PIECE = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<rest>(?:[^\"'>]++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)(?:>|\Z)"
    r"|[^<]+|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
#: Elements whose content is no markup.
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes svg math".split())
#: Elements that never hold main text.
DROPPED = frozenset(
    "head nav footer aside form button select option label fieldset dialog menu object "
    "audio video canvas map datalist".split()
)
MAIN = frozenset(["article", "main"])
#: Elements that are followed as containers; other tags only end a block, or nothing.
CONTAINERS = DROPPED | MAIN | frozenset(
    "html body div section header ul ol dl table blockquote figure details center".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data dfn em font i ins kbd mark q s samp small "
    "span strike strong sub sup time tt u var wbr del".split()
)
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
LINES = frozenset(["p", "li", "dt", "dd"]) | HEADINGS
#: Elements that end, closed or not, where one of the others begins.
ENDED = {"p": LINES, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}} | dict.fromkeys(HEADINGS, LINES)
#: Words in a class, id or role that hint at a container that is no part of the main text.
MARKS = frozenset(
    "ad ads adv advert advertisement adsense banner promo promotion sponsor sponsored nav "
    "navbar navigation menu menubar breadcrumb breadcrumbs sidebar footer cookie cookies "
    "consent notice notices notification alert popup modal overlay newsletter subscribe "
    "subscription signup login comment comments reply replies respond disqus discussion share "
    "sharing social related recommended search pagination pager toolbar contentinfo "
    "complementary masthead skip copyright disclaimer".split()
)
#: Words that say nothing beside such a word: ``ad-box``, ``comment-list``.
PLAIN = frozenset(
    "area article articles bar block body bottom box btn button buttons col column container "
    "content div element entry form google grid group header holder icon icons inner item items "
    "js left link links list main middle module news outer page panel post posts primary reader "
    "readers right row secondary section site slot small stories story text thread title top "
    "trail user widget widgets wide wrap wrapper x".split()
)
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
#: Zones of blocks: not named by markup; main part; no main part; a hint says it is none; main
#: part, but a hint says it is none.
OPEN, KEPT, GONE, HINTED, DOUBTED = 0, 1, 2, 3, 4


@dataclass
class Page:
    """Blocks of a page, in order: zone, path of containers, words."""

    blocks: list[tuple[int, str, list[str]]] = field(default_factory=list)


def attributes(rest: str) -> dict[str, str]:
    found = ATTRIBUTE.findall(rest)
    return {k.lower(): html.unescape(v.strip("\"'")).lower() for k, v in reversed(found)}


def hints(name: str) -> bool:
    """Whether a name of a class, id or role as a whole says that this is no main text."""
    words = [w for w in re.split(r"[^a-z]+", name) if w and w not in PLAIN]
    return bool(words) and MARKS.issuperset(words)


def marked(rest: str) -> int:
    """What the attributes say: ``GONE`` (not shown), ``HINTED`` (class, id, role), or ``OPEN``."""
    if not rest or "=" not in rest and "hidden" not in rest.lower():
        return OPEN
    own = attributes(rest)
    if (
        "hidden" in own
        or own.get("aria-hidden") == "true"
        or "display:none" in own.get("style", "").replace(" ", "")
    ):
        return GONE
    names = " ".join(own.get(k, "") for k in ("class", "id", "role")).split()
    return HINTED if any(hints(n) for n in names) else OPEN


def zone_inside(tag: str, rest: str, outer: int) -> int:
    """Zone of the content of a container, by its own markup and the zone it is in."""
    said = marked(rest) if tag not in ("html", "body") else OPEN
    if GONE in (outer, said) or tag in DROPPED:
        return GONE
    if tag in MAIN or "role" in rest.lower() and attributes(rest).get("role") in MAIN:
        if tag == "main" or said == OPEN:
            return DOUBTED if outer in (HINTED, DOUBTED) else KEPT
        return DOUBTED
    if said == HINTED:
        return HINTED
    if tag == "header" and outer == OPEN:
        return GONE
    return outer


def read(source: str) -> Page:
    """Cut a page into blocks; broken markup never fails."""
    page, parts = Page(), []
    stack: list[tuple[str, int]] = []  # open containers and the zone inside each
    inline: list[tuple[str, int]] = []  # open inline elements that are marked

    def zone() -> int:
        if inline:
            return inline[0][1]
        return stack[-1][1] if stack else OPEN

    def flush() -> None:
        words = html.unescape("".join(parts)).split()
        parts.clear()
        if words:
            page.blocks.append((zone(), "/".join(t for t, _ in stack), words))

    at, size = 0, len(source)
    while at < size:
        found = PIECE.match(source, at)
        at = found.end()
        tag = found["tag"]
        if tag is None:
            text = found.group()
            if not text.startswith(("<!", "<?")):
                parts.append(text)
            continue
        tag, closing = tag.lower(), bool(found["close"])
        if tag in RAW:
            if not closing and not found["rest"].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
                if tag not in ("svg", "math") or end:
                    at = end.end() if end else size
            continue
        if tag in INLINE:
            if inline:
                if closing and inline[-1][0] == tag:
                    flush()
                    inline.pop()
                elif not closing and inline[-1][0] == tag:
                    inline.append((tag, GONE))
            elif not closing and zone() != GONE and (said := marked(found["rest"])):
                flush()
                inline.append((tag, said))
            continue
        flush()
        inline.clear()
        if tag in VOID:
            continue
        if closing:
            for depth in range(len(stack) - 1, -1, -1):
                if stack[depth][0] == tag:
                    del stack[depth:]
                    break
            continue
        outer = stack[-1][1] if stack else OPEN
        if tag in CONTAINERS:
            if found["rest"].endswith("/") and tag not in MAIN:
                continue
            stack.append((tag, zone_inside(tag, found["rest"], outer)))
        else:
            if stack and tag in ENDED.get(stack[-1][0], ()):
                stack.pop()  # a marked paragraph ends where the next begins
                outer = stack[-1][1] if stack else OPEN
            said = marked(found["rest"]) if outer != GONE else OPEN
            if said:
                stack.append((tag, said))
    flush()
    return page


def chosen(blocks: list[tuple[int, str, list[str]]]) -> tuple[int | None, int]:
    """Zone of the main part, None if the page has none; and the zone its host then judges."""
    zones = {zone for zone, _, _ in blocks}
    main = next((z for z in (KEPT, DOUBTED) if z in zones), None)
    return main, HINTED if OPEN not in zones else OPEN


def host_of(url: str | None) -> str:
    """Host of an address, without a leading ``www.``; empty if there is none."""
    found = re.match(r"\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]*)", url or "", re.I)
    return found[1].lower().removeprefix("www.") if found else ""


def codes(words: list[str]) -> np.ndarray:
    digest = lambda w: int.from_bytes(hashlib.blake2b(w.encode("utf-8", "replace"), digest_size=8).digest(), "little")
    return np.array([digest(w) for w in words], np.uint64)


def names(tokens: np.ndarray, length: int) -> np.ndarray:
    """Names of all strings of ``length`` tokens, by doubling."""
    if len(tokens) < length:
        return np.empty(0, np.int64)

    def pair(a, b):
        h = (a ^ (b * np.uint64(0xD6E8FEB86659FD93) + np.uint64(length))) * np.uint64(0x9E3779B97F4A7C15)
        return h ^ (h >> np.uint64(32))

    span, h = 1, tokens
    while 2 * span <= length:
        h = pair(h[:-span], h[span:])
        span *= 2
    n = len(tokens) - length + 1
    return pair(h[:n], h[length - span : length - span + n]).view(np.int64)


def stream(blocks: list[tuple[int, str, list[str]]]) -> tuple[list[str], list[int]]:
    """Tokens outside the main part, and for each the number of its block (-1: path)."""
    tokens, owner = [], []
    main, _ = chosen(blocks)
    for i, (zone, path, words) in enumerate(blocks):
        if main is None or zone != main:
            tokens += ["\0" + path, *words]
            owner += [-1, *[i] * len(words)]
    return tokens, owner


def unique_text(blocks, tokens: list[str], owner: list[int], starts: list[int], length: int) -> str:
    """Words of the blocks to be judged that no repeated string covers."""
    _, judged = chosen(blocks)
    covered = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(covered, np.asarray(starts, np.int64), 1)
    np.add.at(covered, np.asarray(starts, np.int64) + length, -1)
    covered = np.cumsum(covered)[:-1] > 0
    return " ".join(
        t for t, o, c in zip(tokens, owner, covered.tolist(), strict=True) if o >= 0 and not c and blocks[o][0] == judged
    )


def _read(min_tokens: int):
    """Main text of a page if its markup tells, else its source; the names on the page."""

    def run(batches):
        for batch in batches:
            urls = batch.column("_url").to_pylist()
            texts, hosts, found, unsure = [], [], [], []
            for url, source in zip(urls, batch.column("_html").to_pylist(), strict=True):
                blocks = read(source).blocks
                zone_of_main, _ = chosen(blocks)
                main = [" ".join(words) for zone, _, words in blocks if zone == zone_of_main]
                texts.append(" ".join(main))
                unsure.append(not main)
                hosts.append(host_of(url))
                tokens, _ = stream(blocks)
                found.append(np.unique(names(codes(tokens), min_tokens)).tolist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_url"),
                    batch.column("_page"),
                    pa.array(hosts, pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(unsure, pa.bool_()),
                    pa.array([s if u else None for s, u in zip(batch.column("_html").to_pylist(), unsure, strict=True)], pa.string()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                ["_id", "_url", "_page", "host", "text", "unsure", "source", "names"],
            )

    return run


def _resolved(min_tokens: int):
    def run(batches):
        for batch in batches:
            texts = []
            repeated = batch.column("repeated").to_pylist()
            for source, known in zip(batch.column("source").to_pylist(), repeated, strict=True):
                blocks = read(source).blocks
                tokens, owner = stream(blocks)
                hits = np.isin(names(codes(tokens), min_tokens), np.array(known or [], np.int64))
                texts.append(unique_text(blocks, tokens, owner, np.flatnonzero(hits).tolist(), min_tokens))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_url"), pa.array(texts, pa.string())],
                ["_id", "_url", "text"],
            )

    return run


def extract(
    pages: DataFrame,
    min_tokens: int = MIN_TOKENS,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
) -> DataFrame:
    """Main text of every page: ``page_id, url, text, n_chars``, one row per row of ``pages``.

    White space inside a block is one space, blocks are joined by one space in page order.
    Null and empty sources, and pages without main text, give an empty text. A null url is a
    host of its own name (empty). Rows that repeat are one page for the host's repetitions
    and each give a result. Null ids are ids. Other columns are ignored; an empty table gives
    an empty table.
    """
    source = F.coalesce(F.col(html_column), F.lit(""))
    own = pages.select(
        F.col(id_column).alias("_id"),
        F.col(url_column).cast("string").alias("_url"),
        F.xxhash64(F.col(id_column), F.col(url_column), source).alias("_page"),
        source.alias("_html"),
    )
    kind = own.schema["_id"].dataType.simpleString()
    seen = written(
        own.mapInArrow(
            _read(min_tokens),
            f"_id {kind}, _url string, _page long, host string, text string, unsure boolean, "
            "source string, names array<long>",
        )
    )
    windows = seen.select("host", "_page", "unsure", F.explode("names").alias("name"))
    repeated = written(
        windows.groupBy("host", "name")
        .agg(F.min("_page").alias("a"), F.max("_page").alias("b"), F.max("unsure").alias("asked"))
        .where("a <> b AND asked")
        .select("host", "name")
    )
    mine = (
        windows.where("unsure")
        .select("host", "_page", "name")
        .distinct()
        .join(repeated, ["host", "name"])
        .groupBy("_page")
        .agg(F.collect_list("name").alias("repeated"))
    )
    open_ = (
        seen.where("unsure")
        .join(mine, "_page", "left")
        .select("_id", "_url", "source", "repeated")
        .mapInArrow(_resolved(min_tokens), f"_id {kind}, _url string, text string")
    )
    done = seen.where("NOT unsure").select("_id", "_url", "text").unionByName(open_)
    return done.select(
        F.col("_id").alias("page_id"),
        F.col("_url").alias("url"),
        "text",
        characters("text").alias("n_chars"),
    )


def characters(column: str) -> Column:
    return F.length(column).cast("long")

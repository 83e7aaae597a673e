"""HTML pages -> token relation -> document state (windows) -> title, content, links.

The reference walks a page once with a small state machine.  Here the page
is exploded into ``tokens(page_id, pos, tok)`` and every piece of state is a
prefix computation over ``Window.partitionBy('page_id').orderBy('pos')``:

* ``in_title``   last title open/close event            (last_value ignore nulls)
* ``skip/pre``   clamped depth counters                 (running sum, running min)
* ``in_anchor``  with ``lwb``, "last output was a break": two states that depend on each other, settled edge by edge
                 (last_value of what each stretch between two edges does, see ``document_state``)
* ``marker``     pending list marker                    (last_value)

Each token then emits ordered output *pieces*; one ``groupBy(page_id)``
concatenates them in order and a fixed chain of regexes finishes the text.
An anchor's pieces come out where it ends: at the first closing token of its
stretch (``_segments``), so tokens are sorted once, in one direction.
Pages are shuffled once, as compact rows, on ``page_id`` before the
generator; every window and the final aggregate reuse that partitioning.
Page size is bounded by the body cap, so no page is an unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.constants import (ATTR_NAME_RE, ATTR_RE, ATTR_VALUE_RE, BLOCK_TAGS,
                                   BRK, FENCE, HEADING_LEVELS, SKIP_TAGS, STRIP,
                                   TAG_NAME_RE, TOKEN_RE, WS)
from ..functions.text import (collapse_ws, decode_html_entities, js_trim,
                              normalize_ws)
from ..options import ExtractOptions


def _w(frame_end: int = 0):
    """Running frame over the page's tokens (built lazily: needs a session)."""
    return Window.partitionBy("page_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, frame_end)

# Events of a token for anchors and breaks; the first three end whatever anchor is open.
EV_ANCHOR, EV_BREAK, EV_CLOSE, EV_SOFT, EV_TEXT = 1, 2, 3, 4, 5

HEADINGS = tuple(HEADING_LEVELS)
BLOCKS_NO_PRE = tuple(t for t in BLOCK_TAGS if t != "pre")


def attributes(tok) -> Column:
    """Map of a tag's attributes, names in lower case; of equal names the last one counts, a bare one has ''."""
    found = F.regexp_extract_all(F.col(tok) if isinstance(tok, str) else tok, F.lit(ATTR_RE), 0)
    pairs = F.array_sort(F.transform(found, lambda a, i: F.struct(
        F.lower(F.regexp_extract(a, ATTR_NAME_RE, 1)).alias("name"), (-i).alias("i"),
        F.concat(*[F.regexp_extract(a, ATTR_VALUE_RE, k) for k in (1, 2, 3)]).alias("value"))))
    # sorted by name, the last one first: it stays where the name before it differs
    names = F.transform(pairs, lambda p: p["name"])
    return F.transform(F.array(F.struct(pairs.alias("pairs"), names.alias("names"))), lambda x: F.map_from_entries(F.transform(
        F.filter(x["pairs"], lambda p, i: (i == 0) | (F.get(x["names"], i - 1) != p["name"])), lambda p: F.struct(p["name"], p["value"]))))[0]


def attr(name: str) -> Column:
    """Attribute ``name`` of a link or image token, NULL if absent."""
    return F.try_element_at(F.col("attrs"), F.lit(name))


def tokenize(pages: DataFrame, clustered: bool = False) -> DataFrame:
    """``pages(page_id, html)`` -> ``tokens(page_id, pos, tok, kind, name, closing)``.

    Comments and name-less tags (doctype, ``<?xml``) have no effect and are
    dropped here; ``pos`` keeps the original token index.  ``clustered=True``
    (pages read from a table bucketed by ``page_id``) skips the explicit
    shuffle; if the input is not in fact clustered, Spark still inserts the
    exchange the windows require, so results never depend on the flag.
    """
    # the three noncharacters that mark breaks and fences below cannot come from a page
    src = pages.select("page_id", F.translate("html", BRK + STRIP + FENCE, "\uFFFD" * 3).alias("html"))
    t = ((src if clustered else src.repartition("page_id"))
         # an empty text token closes every page: each page yields rows even
         # without tokens, so no join back to ``pages`` is needed
         .select("page_id", F.posexplode(F.array_append(
             F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(TOKEN_RE), 0), F.lit("")))
                 .alias("pos", "tok")))
    is_tag = F.col("tok").startswith("<")
    t = t.select(
        "page_id", "pos", "tok",
        F.when(F.col("tok").startswith("<!--"), "comment")
         .when(is_tag, "tag").otherwise("text").alias("kind"),
        F.when(is_tag, F.lower(F.regexp_extract("tok", TAG_NAME_RE, 1))).alias("name"),
        F.col("tok").startswith("</").alias("closing"),
    )
    # read once for each link and image, as a map
    t = t.withColumn("attrs", F.when((F.col("kind") == "tag") & ~F.col("closing") & F.col("name").isin("a", "img"), attributes("tok")))
    return t.filter((F.col("kind") == "text") | ((F.col("kind") == "tag") & (F.col("name") != "")))


def document_state(tokens: DataFrame) -> DataFrame:
    """Add every state column of the reference walker to the token relation."""
    W_INC, W_EXC = _w(0), _w(-1)
    tag = F.col("kind") == "tag"
    text = F.col("kind") == "text"
    name, closing = F.col("name"), F.col("closing")
    t_open = tag & ~closing & (name == "title")
    t_close = tag & closing & (name == "title")

    s = tokens.select(
        "*",
        F.coalesce(F.last(F.when(t_open, True).when(t_close, False), True).over(W_EXC),
                   F.lit(False)).alias("in_title"),
        F.sum(t_open.cast("int")).over(W_INC).alias("title_seg"),
    )
    active = ~F.col("in_title") & ~t_open
    s = s.withColumn("active", active)
    o = F.col("active") & tag & ~closing
    c = F.col("active") & tag & closing
    s = s.select(
        "*",
        F.sum(F.when(o & name.isin(*SKIP_TAGS), 1).when(c & name.isin(*SKIP_TAGS), -1)
              .otherwise(0)).over(W_INC).alias("s_skip"),
        F.sum(F.when(o & name.isin("pre", "code"), 1).when(c & name.isin("pre", "code"), -1)
              .otherwise(0)).over(W_INC).alias("s_pre"),
    )
    # clamped counters: c_n = S_n - min(0, min_k<=n S_k)
    s = s.select(
        "*",
        (F.col("s_skip") - F.least(F.lit(0), F.min("s_skip").over(W_INC))).alias("skip"),
        (F.col("s_pre") - F.least(F.lit(0), F.min("s_pre").over(W_INC))).alias("pre"),
    )
    pre0 = F.col("pre") == 0
    txt = text & F.col("active") & (F.col("skip") == 0)
    s = s.select("*", F.when(txt, decode_html_entities("tok")).alias("dec")).withColumn("clean", F.when(txt & pre0, normalize_ws("dec")))
    # what a token does to the pair (anchor open, last output was a break)
    a_open = o & (name == "a")
    closes = ((o | c) & ((name == "a") | name.isin("li", "pre", *HEADINGS, *BLOCK_TAGS))) | (o & (name == "img"))
    forced = pre0 & ((o & name.isin("li", *HEADINGS, *BLOCKS_NO_PRE)) | (c & name.isin("li", "pre", *HEADINGS, *BLOCKS_NO_PRE)))
    soft = o & name.isin("br", "hr") & pre0
    emits = txt & pre0 & (F.col("clean") != "")
    event = (F.when(a_open, EV_ANCHOR).when(forced, EV_BREAK).when(closes, EV_CLOSE).when(soft, EV_SOFT).when(emits, EV_TEXT)).cast("byte")
    s = s.select("*", a_open.alias("a_open"), emits.alias("emits"), event.alias("ev"))
    ev = F.col("ev")
    edge = ev <= EV_CLOSE  # opens an anchor or ends one whatever came before
    s = s.select(
        "*", edge.alias("edge"), F.last("ev", True).over(W_EXC).alias("prev"), F.last(F.when(edge, ev), True).over(W_EXC).alias("prev_edge"),
        F.coalesce(F.last(F.when(edge, False).when(ev == EV_SOFT, True), True).over(W_EXC), F.lit(False)).alias("softened"),
        F.sum(F.col("a_open").cast("int")).over(W_INC).alias("anchor_seq"),
    )
    # Between two edges the state is settled by the state at the first one: a soft break closes an anchor, and text
    # behind it is no label, only if the anchor was opened when the last output was no break. So what a whole stretch
    # does to "last output was a break" is a constant or nothing, and the last constant is the state at each edge.
    prev, in_a = F.col("prev"), F.coalesce(F.col("prev_edge") == EV_ANCHOR, F.lit(False))
    stretch = (F.when(prev.isin(EV_BREAK, EV_SOFT), True).when((prev == EV_TEXT) & ~in_a, False))
    s = s.select("*", F.coalesce(F.last(F.when(F.col("edge"), stretch), True).over(W_INC), F.lit(False)).alias("at_edge"))
    at_edge, softened = F.col("at_edge"), F.col("softened")
    since = F.when(prev == EV_SOFT, True).when(prev == EV_TEXT, False)
    lwb = (F.when(F.col("edge"), at_edge).when(in_a, at_edge | F.coalesce(softened & since, F.lit(False)))
           .otherwise(F.coalesce(since, F.when(prev == EV_BREAK, True), at_edge)))
    in_anchor = in_a & (at_edge | ~softened)
    s = s.withColumns({"lwb": lwb, "direct": F.col("emits") & ~in_anchor, "label": F.col("emits") & in_anchor})
    brk_call = F.coalesce(ev.isin(EV_BREAK, EV_SOFT), F.lit(False))
    s = s.withColumns({"direct": F.coalesce("direct", F.lit(False)), "label": F.coalesce("label", F.lit(False)), "brk_call": brk_call,
                       "brk": brk_call & ~F.col("lwb"), "closer": F.coalesce(F.col("edge") | ((ev == EV_SOFT) & ~F.col("lwb")), F.lit(False))})
    li_open = o & (name == "li")
    return s.select(
        "*", F.coalesce(F.last(F.when(F.col("a_open"), True).when(F.col("label"), False), True).over(W_EXC), F.lit(False)).alias("label_first"),
        F.coalesce(F.last(F.when(li_open, True).when(F.col("brk") | F.col("direct"), False), True).over(W_EXC), F.lit(False)).alias("marker"),
    )


def _piece(k1, k2, k3, s) -> Column:
    """Output piece ordered by (k1, k2, k3): anchor pieces sort at the token that ends the anchor, see ``_segments``."""
    def num(v):
        return (F.col(v) if isinstance(v, str) else F.lit(v)).cast("bigint")
    return F.struct(num(k1).alias("k1"), F.lit(k2).alias("k2"), num(k3).alias("k3"), s.alias("s"))


def _pieces(s: DataFrame, md: bool) -> DataFrame:
    """Per token: ``a`` = anchor-ordered piece, ``b`` = the token's own piece."""
    name, closing, tag = F.col("name"), F.col("closing"), F.col("kind") == "tag"
    o = F.col("active") & tag & ~closing
    c = F.col("active") & tag & closing
    brk = F.when(F.col("brk"), F.lit(BRK)).otherwise(F.lit(""))
    href = F.coalesce(attr("href"), F.lit(""))
    linked = F.lit(md) & (F.col("href") != "")
    alt = js_trim(F.coalesce(attr("alt"), F.lit("")))
    src = F.coalesce(attr("src"), F.lit(""))
    img = (F.when(F.lit(md) & (src != ""), F.concat(F.lit("!["), alt, F.lit("]("), src, F.lit(") ")))
           .when(alt != "", F.concat(alt, F.lit(" "))).otherwise(F.lit("")))
    heading = F.lit("")
    if md:
        for h, n in HEADING_LEVELS.items():
            heading = F.when(name == h, F.lit("#" * n + " ")).otherwise(heading)
    raw_txt = (F.col("kind") == "text") & F.col("active") & (F.col("skip") == 0) & (F.col("pre") > 0)
    own = (
        F.when(raw_txt, F.col("dec"))
        .when(F.col("direct"), F.when(F.col("marker") & F.lit(md), F.concat(F.lit("- "), F.col("clean")))
              .otherwise(F.concat(F.col("clean"), F.lit(" "))))
        .when(o & (name == "img"), img)
        .when(o & (name == "hr"), F.concat(brk, F.lit("---\n" if md else "\n")))
        .when(o & name.isin(*HEADINGS), F.concat(brk, heading))
        .when(o & (name == "pre"), F.lit("```\n" if md else ""))
        .when(c & (name == "pre"), F.concat(F.lit(STRIP), F.lit(FENCE if md else ""), brk))
        .when(F.col("brk_call"), brk)
    )
    s = s.withColumn("href", F.when(F.col("a_open"), href))
    anchor_a = (
        F.when(F.col("a_open"), _piece(None, 0, "pos", F.when(linked, F.lit("[")).otherwise(F.lit(""))))
        .when(F.col("label"), _piece(None, 1, "pos",
                                     F.concat(F.when(F.col("label_first"), F.lit("")).otherwise(F.lit(" ")),
                                              collapse_ws("clean"))))
    )
    anchor_b = F.when(F.col("a_open"), _piece(None, 2, "pos",
                                              F.when(linked, F.concat(F.lit("]("), F.col("href"), F.lit(")")))
                                              .otherwise(F.lit(""))))
    return s.select(
        "*",
        anchor_a.alias("piece_a"),
        F.coalesce(anchor_b, F.when(own.isNotNull() & (own != ""), _piece("pos", 5, 0, own))).alias("piece_b"),
    )


def _segments(s: DataFrame, with_links: bool) -> DataFrame:
    """Per ``(page_id, anchor_seq)``: its output pieces, what it holds of the title, and its link.

    No token between an anchor's opening and its last label ends it, so all its pieces come out at the first closer
    behind the opening. If the segment holds none, that is the opening of the next one, or the page ends: behind the
    segment's last token either way.
    """
    title_txt = (F.col("kind") == "text") & F.col("in_title")
    title_done = (F.col("kind") == "tag") & F.col("closing") & (F.col("name") == "title") & F.col("in_title")
    link = [F.max(F.when(F.col("a_open"), F.col("pos"))).alias("link_pos"), F.max("href").alias("href"),
            F.collect_list(F.when(F.col("label"), F.struct("pos", collapse_ws("clean").alias("t")))).alias("lparts")]
    seg = s.groupBy("page_id", "anchor_seq").agg(
        F.collect_list("piece_a").alias("pa"),
        F.collect_list("piece_b").alias("pb"),
        F.coalesce(F.min(F.when(F.col("closer") & ~F.col("a_open"), F.col("pos"))), F.max("pos") + 1).cast("bigint").alias("end"),
        F.max(F.when(title_done, F.col("title_seg"))).alias("tseg"),
        F.collect_list(F.when(title_txt, F.struct("title_seg", "pos", "tok"))).alias("tparts"),
        *(link if with_links else ()),
    )
    pieces = F.transform(F.concat("pa", "pb"), lambda p: F.struct(F.coalesce(p["k1"], F.col("end")).alias("k1"), p["k2"].alias("k2"), p["k3"].alias("k3"), p["s"].alias("s")))
    links = [F.when(F.col("href") != "", F.struct(
        F.col("link_pos").alias("link_pos"),
        F.array_join(F.transform(F.array_sort("lparts"), lambda x: x["t"]), " ").alias("text"),
        F.col("href").alias("href"))).alias("link")]
    return seg.select("page_id", pieces.alias("pieces"), "tseg", "tparts", *(links if with_links else ()))


def finish_content(raw: Column, max_chars: int):
    """Resolve output markers, normalise, re-space markdown links, cap. Returns (content, truncated)."""
    r = F.regexp_replace(raw, "[ \\t]*" + STRIP, "")
    # a closing fence is left out where the output ends in a fence line already: right behind an opening one, or
    # behind a fence that a break (or a line end of the page) has ended; further breaks add nothing there
    r = F.regexp_replace(r, "(" + FENCE + "|```)([ \\t]*" + BRK + "|\\n)[ \\t" + BRK + FENCE + "]*", "$1$2")
    r = F.regexp_replace(r, FENCE, "\n```")
    r = F.regexp_replace(r, "[ \\t]*" + BRK + "(?:[ \\t]*" + BRK + ")*", BRK)
    r = F.regexp_replace(r, "\\n" + BRK, "\n")
    r = F.regexp_replace(r, BRK, "\n")
    r = normalize_ws(r)
    r = F.regexp_replace(r, "\\]\\(([^)]*)\\)" + WS + "+", "]($1) ")
    r = F.regexp_replace(r, " {2,}", " ")
    r = F.regexp_replace(r, " *\\n *", "\n")
    r = F.regexp_replace(r, "\\n{3,}", "\n\n")
    full = js_trim(r)
    return full, F.length(full) > max_chars


def page_state(pages: DataFrame, clustered: bool = False) -> DataFrame:
    return document_state(tokenize(pages, clustered))


def extract(pages: DataFrame | None = None, opts: ExtractOptions = ExtractOptions(),
            state: DataFrame | None = None, with_links: bool = True) -> DataFrame:
    """-> ``(page_id, title, content, length, truncated, links)``; ``links`` = raw anchors in order.

    Two aggregation levels, both on the ``page_id`` partitioning of the token
    relation (no further shuffle): per anchor segment ``(page_id, anchor_seq)``
    the link label and the output pieces, then per page the ordered text.
    """
    s = _pieces(state if state is not None else page_state(pages), opts.markdown)
    agg = _segments(s, with_links).groupBy("page_id").agg(
        F.flatten(F.collect_list("pieces")).alias("pieces"),
        F.max("tseg").alias("tseg"),
        F.flatten(F.collect_list("tparts")).alias("tparts"),
        *([F.array_sort(F.collect_list("link")).alias("links")] if with_links else ()),
    )
    if not with_links:
        agg = agg.withColumn("links", F.array().cast("array<struct<link_pos:bigint,text:string,href:string>>"))
    return _finish(agg, opts)


def _finish(agg: DataFrame, opts: ExtractOptions) -> DataFrame:
    raw = F.array_join(F.transform(F.array_sort("pieces"), lambda p: p["s"]), "")
    title_raw = F.array_join(F.transform(
        F.filter(F.array_sort("tparts"), lambda x: x["title_seg"] == F.col("tseg")), lambda x: x["tok"]), "")
    full, _ = finish_content(raw, opts.max_chars)
    out = agg.select(
        "page_id",
        F.when(F.col("tseg").isNotNull(), collapse_ws(decode_html_entities(title_raw)))
         .otherwise(F.lit("")).alias("title"),
        full.alias("full"),
        F.transform("links", lambda x: F.struct(x["text"].alias("text"), x["href"].alias("href"))).alias("links"),
    )
    return out.select(
        "page_id", "title",
        F.substring("full", 1, opts.max_chars).alias("content"),
        F.least(F.length("full"), F.lit(opts.max_chars)).alias("length"),
        (F.length("full") > opts.max_chars).alias("truncated"),
        "links",
    )


def titles(pages: DataFrame) -> DataFrame:
    """P4 alone: ``(page_id, title)`` with one window stage instead of the full state stack."""
    t = tokenize(pages)
    tag = F.col("kind") == "tag"
    t_open = tag & ~F.col("closing") & (F.col("name") == "title")
    t_close = tag & F.col("closing") & (F.col("name") == "title")
    s = t.select(
        "page_id", "pos", "tok", "kind", t_close.alias("t_close"),
        F.coalesce(F.last(F.when(t_open, True).when(t_close, False), True).over(_w(-1)),
                   F.lit(False)).alias("in_title"),
        F.sum(t_open.cast("int")).over(_w(0)).alias("title_seg"),
    )
    agg = s.groupBy("page_id").agg(
        F.max(F.when(F.col("t_close") & F.col("in_title"), F.col("title_seg"))).alias("tseg"),
        F.collect_list(F.when((F.col("kind") == "text") & F.col("in_title"),
                              F.struct("title_seg", "pos", "tok"))).alias("tparts"))
    raw = F.array_join(F.transform(
        F.filter(F.array_sort("tparts"), lambda x: x["title_seg"] == F.col("tseg")), lambda x: x["tok"]), "")
    return agg.select("page_id", F.when(F.col("tseg").isNotNull(), collapse_ws(decode_html_entities(raw)))
                      .otherwise(F.lit("")).alias("title"))


def raw_links(state: DataFrame) -> DataFrame:
    """Every anchor with a non-empty href, in document order: ``(page_id, link_pos, text, href)``.

    Anchors inside dropped elements are kept (label ''), as in the reference.
    """
    a = state.filter(F.col("a_open") | F.col("label"))
    grouped = a.groupBy("page_id", "anchor_seq").agg(
        F.max(F.when(F.col("a_open"), F.col("pos"))).alias("link_pos"),
        F.max(F.when(F.col("a_open"), F.coalesce(attr("href"), F.lit("")))).alias("href"),
        F.collect_list(F.when(F.col("label"), F.struct("pos", collapse_ws("clean").alias("t")))).alias("parts"),
    )
    return grouped.filter(F.col("href") != "").select(
        "page_id", "link_pos",
        F.array_join(F.transform(F.array_sort("parts"), lambda x: x["t"]), " ").alias("text"),
        "href")


def images(state: DataFrame) -> DataFrame:
    """``page_images(page_id, pos, alt, src)``: every active ``<img>``."""
    img = state.filter(F.col("active") & (F.col("kind") == "tag") & ~F.col("closing") & (F.col("name") == "img"))
    return img.select("page_id", "pos",
                      js_trim(F.coalesce(attr("alt"), F.lit(""))).alias("alt"),
                      F.coalesce(attr("src"), F.lit("")).alias("src"))


def outline(state: DataFrame) -> DataFrame:
    """``page_outline(page_id, pos, level, text)``: every visible heading of the whole page.

    A heading holds the text tokens from its opening tag to the next tag of a block element; headings without text
    are left out. Read from the tokens, not from the rendered content, so neither the content cap nor text that
    looks like a markdown heading has a say.
    """
    tag = F.col("active") & (F.col("kind") == "tag")
    opens = tag & ~F.col("closing") & (F.col("skip") == 0) & F.col("name").isin(*HEADINGS)
    edge = F.when(opens, F.col("pos")).when(tag & F.col("name").isin(*BLOCK_TAGS, *HEADINGS, "li", "hr"), F.lit(-1).cast("int"))
    level = F.when(opens, F.element_at(F.create_map(*[F.lit(x) for kv in HEADING_LEVELS.items() for x in kv]), F.col("name")))
    s = state.select("page_id", "pos", "tok", level.alias("lvl"),
                     (F.col("active") & (F.col("kind") == "text") & (F.col("skip") == 0)).alias("txt"),
                     F.last(edge, True).over(_w(0)).alias("h"))
    rows = s.filter((F.col("h") >= 0) & (F.col("txt") | F.col("lvl").isNotNull()))
    parts = F.collect_list(F.when(F.col("txt"), F.struct("pos", "tok")))
    agg = rows.groupBy("page_id", "h").agg(F.max("lvl").alias("level"), parts.alias("parts"))
    raw = F.array_join(F.transform(F.array_sort("parts"), lambda x: x["tok"]), "")
    return agg.select("page_id", F.col("h").alias("pos"), "level", collapse_ws(decode_html_entities(raw)).alias("text")) \
        .filter(F.col("text") != "")


__all__ = ["tokenize", "document_state", "page_state", "extract", "titles", "raw_links", "images", "outline",
           "finish_content", "attr", "attributes"]

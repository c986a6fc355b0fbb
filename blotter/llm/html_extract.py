"""Main text of web pages with a site style tree.

Every page is parsed leniently into blocks under a path of labelled elements.
Pages of one host are merged into one tree: for each path the number of
distinct pages that have it, how its children's tags vary (presentation) and in how
many pages each of its texts recurs (content). A path with texts of its own has
importance 1 - mean(log c / log m) over its distinct texts, where c of m pages
have the text; any other path the entropy of its presentations to base m. A
branch is as important as the most important path in it. Branches below
``LOW`` on at least ``MIN_PAGES`` distinct pages are noise of the site and are
removed from each page, however short the rest is, unless nothing were left. On a host of
``FEW_PAGES`` to ``MIN_PAGES`` - 1 distinct pages a branch is noise if all of them have it
with the same texts; fewer pages are no evidence. So a notice that all pages have goes from hosts of 4 pages
on, and one that all pages but one have from hosts of 9 on, where 8 pages have it. The tree tells branches apart down to ``MAX_DEPTH``
labelled elements; each path below that stands for itself and the branches above it.

Before that, elements that say what they are go: menus, headers outside an
article, footers, sidebars, notices, adverts, forms, scripts, styles, hidden parts and
reader comments, by tag, role, class or id. A class or id condemns no element that
contains an ``article``, ``main`` or ``h1`` (a wrapper of comments or related texts only if
the page has an article elsewhere), and ``header`` in one condemns nothing inside an
article. A form that contains an ``article`` or ``main`` is a wrapper of the page: only its controls and, outside the
article, their labels go. Names such as has-sidebar or no-comments say how something looks, not what it is. What this
spares is left to the tree. Where a page has ``article`` (else ``main``) elements, its text is theirs.

Character references are decoded, white space within a block becomes one space,
blocks are joined in page order by one newline. NULL and empty html give an
empty text. A NULL url belongs to one host of its own; copies of a page count
once in the tree; repeated rows each get their result.

A page is parsed once for the tree, whose checkpointed rows hold paths and hashes only, and once for its blocks, which travel
compressed to its noise (keeping the blocks from the first time would cost more disk than parsing costs time). Memory grows
with the page's length, however deep it nests. A page is known by a 64-bit hash of its row. The tree is an aggregate of (path, text hash) rows, combined in the map tasks, where a path's hash begins with its host's.
The noise branches meet the pages' own paths one by one, on (path, salt): neither the branches of a large host nor its
pages come together in one row or task.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from blotter.llm.common import pick, salted_join, settle, table

LOW = 0.2
MIN_PAGES = 8
FEW_PAGES = 4
MAX_DEPTH = 64
CACHE_PATHS = 100_000

# HTML's elements by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table
tbody td tfoot th thead tr ul""".split())
NOISE_TAGS = frozenset("""head nav footer aside menu dialog button select option textarea input iframe object svg
canvas audio video script style noscript template title""".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NOISE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar
nav navbar navigation menu breadcrumb breadcrumbs footer header masthead cookie cookies consent gdpr notice notices alert
popup modal overlay comment comments disqus reply replies related recommended share sharing social newsletter subscribe
signup login widget toolbar pagination pager skip""".split())
# of an article itself, and of wrappers that may hold the articles of others
OTHERS = frozenset("comment comments disqus reply replies related recommended ad ads advert sponsored promo teaser".split())
CONTENT = frozenset(("article", "main", "h1"))
CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"),
             "option": ("option",)}

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style|title|textarea|noscript|template|iframe)\b[^>]*>.*?(?:</\1\s*>|\Z)"""
    r"""|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""",
    re.S | re.I)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
NAMES = re.compile(r"[A-Za-z]+")
MODIFIER = re.compile(r"(?<!\S)(?:has|have|no|not|with|without|hide|show)(?:[-_]\S*|(?=[A-Z])\S*)")


def _hash(s: str) -> int:
    return struct.unpack("<q", hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest())[0]


class Element:
    """``noise`` is certain; ``doubt`` is the innermost doubt about itself or an ancestor. ``base`` has the
    hashes of its path and those it lies in, down to ``MAX_DEPTH``."""

    __slots__ = ("tag", "hash", "base", "depth", "noise", "doubt", "article", "main", "form", "styled", "kids")

    def __init__(self, tag, path, base, depth, noise, doubt, article, main, form, styled):
        self.tag, self.hash, self.base, self.depth, self.noise, self.doubt = tag, path, base, depth, noise, doubt
        self.article, self.main, self.form, self.styled, self.kids = article, main, form, styled, []

    def chain(self) -> tuple:
        return self.base if self.depth <= MAX_DEPTH else (*self.base, self.hash)


class Doubt:
    """An element condemned by class words only, or a form (``strict``); ``up`` is the doubt around it."""

    __slots__ = ("others", "strict", "up", "h1", "deep")

    def __init__(self, others, strict, up):
        self.others, self.strict, self.up, self.h1, self.deep = others, strict, up, False, False

    def content(self) -> bool:
        return self.deep or (self.h1 and not self.strict)


def _all_up(doubt: Doubt | None, known: dict, test) -> bool:
    """Does ``test`` hold for a doubt and all around it? Each doubt is looked at once."""
    way = []
    while doubt is not None and id(doubt) not in known:
        way.append(doubt)
        doubt = doubt.up
    fine = doubt is None or known[id(doubt)]
    for d in reversed(way):
        fine = known[id(d)] = fine and test(d)
    return fine


def _open(parent: Element, tag: str, raw: str, hashes: dict) -> Element:
    attrs = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(raw)} if raw.strip(" /") else {}
    names = f"{attrs.get('class', '')} {attrs.get('id', '')}".strip()
    words = {w.lower() for w in WORDS.findall(names) + NAMES.findall(names)}
    noise, doubt = parent.noise, parent.doubt
    if not noise:
        if tag not in ("html", "body", "article", "main"):
            noise = (tag in NOISE_TAGS or (tag == "header" and not parent.article) or (tag == "label" and parent.form and not parent.article)
                     or attrs.get("role", "").lower() in NOISE_ROLES or "hidden" in attrs or attrs.get("aria-hidden") == "true"
                     or "display:none" in attrs.get("style", "").replace(" ", "").lower())
        listed = OTHERS if tag == "article" else NOISE_WORDS
        if not noise and tag == "form":
            doubt = Doubt(False, True, doubt)
        if not noise and words and tag not in ("html", "body", "main", "h1") and words & listed:
            said = MODIFIER.sub(" ", names)
            said = {w.lower() for w in WORDS.findall(said) + NAMES.findall(said)} & listed
            if parent.article:
                said.discard("header")
            if said:
                doubt = Doubt(bool(said & OTHERS), False, doubt)
        if not noise and tag in CONTENT and doubt is parent.doubt:
            # an article in doubt says nothing for the elements around it, nor for itself
            d = doubt
            if tag == "h1":
                while d is not None and not d.h1:
                    d.h1, d = True, d.up
            else:
                while d is not None and not d.deep:
                    d.deep, d = True, d.up
    styled = tag in BLOCK or bool(words)
    path, base, depth = parent.hash, parent.base, parent.depth
    if styled:
        label = tag + "".join(f".{w}" for w in sorted(words))
        key = (path, label)
        path = hashes.get(key)
        if path is None:
            if len(hashes) >= CACHE_PATHS:
                hashes.clear()
            path = hashes[key] = _hash(f"{key[0]}>{label}")
        depth += 1
        if depth <= MAX_DEPTH:
            base = (*base, path)
        parent.kids.append(label)
    return Element(tag, path, base, depth, noise, doubt, parent.article or tag == "article",
                   parent.main or tag == "main" or attrs.get("role", "").lower() == "main", parent.form or tag == "form", styled)


def parse(page: str, hashes: dict, host: str = ""):
    """(blocks, styles): blocks are (chain of path hashes, in article, in main, text)
    without those of self-declared noise; styles are (chain, children's labels)."""
    top = _hash(host)
    root = Element("#", top, (top,), 1, False, None, False, False, False, True)
    stack, blocks, styles, held, at = [root], [], [], [], 0
    places: dict[str, list[int]] = {}  # where each tag is open
    lines: list[int] = []              # where elements that break a line are

    def flush():
        text = " ".join(entities.unescape("".join(held)).split())
        held.clear()
        e = stack[-1]
        if text and not e.noise:
            blocks.append((e.chain(), e.article, e.main, text, e.doubt))

    def close(depth):
        # only elements that break a line end a block; what is noise inline ends one as well
        if any(e.styled or e.noise for e in stack[depth:]):
            flush()
        for e in reversed(stack[depth:]):
            places[e.tag].pop()
            if e.tag in BLOCK:
                lines.pop()
        for e in stack[depth:]:
            if e.styled and not e.noise:
                styles.append((e.chain(), e.kids, e.doubt))
        del stack[depth:]

    for m in TOKEN.finditer(page):
        held.append(page[at:m.start()])
        at = m.end()
        tag = (m[3] or m[6] or "").lower()
        if not tag:
            continue
        raw, ending = (m[4], m[2]) if m[3] else (m[7], m[5])
        if ending:
            if places.get(tag):
                close(places[tag][-1])
            elif tag in BLOCK:
                flush()
            continue
        if tag in BLOCK:
            flush()
            if lines and (stack[lines[-1]].tag == "p" or stack[lines[-1]].tag in CLOSED_BY.get(tag, ())):
                close(lines[-1])
        if tag in VOID:
            held.append(" ")
            continue
        e = _open(stack[-1], tag, raw, hashes)
        if (e.styled and tag not in BLOCK) or (e.noise and not stack[-1].noise):
            flush()
        places.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            lines.append(len(stack))
        stack.append(e)
    held.append(page[at:])
    close(1)
    flush()
    # without an article elsewhere, the one among comments or related texts may be the page's own
    own: dict = {}
    elsewhere = any(b[1] and _all_up(b[4], own, lambda d: d.content() and not d.others) for b in blocks)
    known: dict = {}
    spared = lambda doubt: _all_up(doubt, known, lambda d: d.content() and not (d.others and elsewhere))
    return [b[:4] for b in blocks if spared(b[4])], [x[:2] for x in styles if spared(x[2])]


def main_blocks(blocks: list) -> list:
    """Of the article elements if any, else of main, else all."""
    for where in (1, 2):
        inside = [b for b in blocks if b[where]]
        if inside:
            return inside
    return blocks


HEAD = "<III"  # paths, tree entries, blocks


def _pack(blocks: list, styles: list, tree: bool) -> tuple[int, bytes]:
    """A page's hash, and its paths (with their parents) and entries of the site tree, or its paths, blocks and texts."""
    kept = main_blocks(blocks)
    number: dict[int, int] = {}
    parents: list[int] = []

    def place(chain) -> int:
        up = -1
        for h in chain:
            k = number.get(h)
            if k is None:
                k = number[h] = len(parents)
                parents.append(up)
            up = k
        return up

    at = [place(c) for c, *_ in kept]
    texts = "\n".join(t for *_, t in kept)  # no text has a line break
    page, seen = _hash(texts), set()
    if tree:
        seen = {(k, True, _hash(t)) for k, (*_, t) in zip(at, kept)}
        # paths that lead to a kept block, and how their children look
        seen |= {(number[c[-1]], False, _hash(" ".join(k for i, k in enumerate(kids) if i == 0 or kids[i - 1] != k)))
                 for c, kids in styles if c[-1] in number}
        at, texts = [], ""
    entries = list(zip(*seen)) if seen else [(), (), ()]
    raw = b"".join([struct.pack(HEAD, len(parents), len(seen), len(at)), np.array(list(number), np.int64).tobytes(),
                    np.array(parents, np.int32).tobytes(), np.array(entries[0], np.int32).tobytes(), np.array(entries[1], np.uint8).tobytes(),
                    np.array(entries[2], np.int64).tobytes(), np.array(at, np.int32).tobytes(), texts.encode("utf-8", "surrogatepass")])
    return page, zlib.compress(raw, 3)


def _unpack(blob: bytes):
    raw = zlib.decompress(blob)
    paths, entries, blocks = struct.unpack_from(HEAD, raw)
    at, out = struct.calcsize(HEAD), []
    for n, kind in ((paths, "<i8"), (paths, "<i4"), (entries, "<i4"), (entries, "u1"), (entries, "<i8"), (blocks, "<i4")):
        out.append(np.frombuffer(raw, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return (*out, raw[at:].decode("utf-8", "surrogatepass").split("\n") if blocks else [])


def _parse_pages(tree: bool):
    def run(batches):
        hashes: dict = {}
        for b in batches:
            tops, pages, packed = [], [], []
            for host, raw in zip(b.column("host").to_pylist(), b.column("raw").to_pylist()):
                page, blob = _pack(*parse(raw.decode("utf-8", "replace"), hashes, host), tree)
                tops.append(_hash(host))
                pages.append(page)
                packed.append(blob)
            rest = [c for c in b.schema.names if c not in ("host", "raw")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(tops, pa.int64()), pa.array(pages, pa.int64()),
                                              pa.array(packed, pa.binary())], names=[*rest, "top", "page", "packed"])
    return run


def _tree_rows(batches):
    """(chain, content, value, page): what the site tree counts; the root comes once for each page."""
    for b in batches:
        rows = []
        for top, page, blob in zip(*(b.column(c).to_pylist() for c in ("top", "page", "packed"))):
            paths, parents, node, content, value, _, _ = _unpack(blob)
            names, chains = paths.tolist(), []
            for k, up in enumerate(parents.tolist()):
                chains.append(struct.pack("<q", names[k]) if up < 0 else chains[up] + struct.pack("<q", names[k]))
            rows.append((struct.pack("<q", top), False, 0, page))
            rows += [(chains[k], bool(c), v, page) for k, c, v in zip(node.tolist(), content.tolist(), value.tolist())]
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows), (pa.binary(), pa.bool_(), pa.int64(), pa.int64()))],
                                         names=["chain", "content", "value", "page"]) if rows else pa.RecordBatch.from_pylist(
            [], pa.schema([("chain", pa.binary()), ("content", pa.bool_()), ("value", pa.int64()), ("page", pa.int64())]))


def _chain_hashes(batches):
    """Add the path's own hash and its ancestors' (itself included)."""
    for b in batches:
        chains = [list(struct.unpack(f"<{len(c) // 8}q", c)) for c in b.column("chain").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in chains], pa.int64()), pa.array([c[-1] for c in chains], pa.int64()),
                                          pa.array(chains, pa.list_(pa.int64())), b.column("m"), b.column("importance")],
                                         names=["top", "path", "ups", "m", "importance"])


def site_noise(parsed: DataFrame) -> DataFrame:
    """path: hashes of the topmost low-importance branches of all hosts, from columns top, page and packed."""
    rows = parsed.select("top", "page", "packed").mapInArrow(_tree_rows, "chain binary, content boolean, value long, page long")
    counts = (rows.distinct().groupBy("chain", "content", "value").agg(F.count(F.lit(1)).alias("c")))
    paged = rows.select("chain", "page").distinct().groupBy("chain").agg(F.count(F.lit(1)).alias("m"))
    base = F.log(F.greatest(F.col("m"), F.lit(2)).cast("double"))
    # averages per path first, so that a path with many texts is combined in the map tasks
    per_path = (counts.groupBy("chain").agg(
        F.avg(F.when(F.col("content"), F.log("c"))).alias("mean_log_c"),
        F.sum(F.when(~F.col("content"), F.col("c"))).alias("total"),
        F.sum(F.when(~F.col("content"), F.col("c") * F.log("c"))).alias("c_log_c")).join(paged, "chain"))
    # entropy of shares c / total, to base m
    by_style = (F.log("total") - F.col("c_log_c") / F.col("total")) / base
    important = F.when(F.col("m") < 2, F.lit(1.0)).otherwise(F.coalesce(1 - F.col("mean_log_c") / base, by_style, F.lit(1.0)))
    paths = settle(per_path.select("chain", "m", important.alias("importance"))
                   .mapInArrow(_chain_hashes, "top long, path long, ups array<long>, m long, importance double"))
    branches = (paths.select(F.explode("ups").alias("path"), "importance")
                .groupBy("path").agg(F.max("importance").alias("most")))
    own = paths.filter(F.size("ups") > 1).select("top", "path", "m", F.get("ups", F.size("ups") - 2).alias("parent"))
    hosts = paths.filter(F.size("ups") == 1).select("top", F.col("m").alias("pages"))
    everywhere = (F.col("pages") < MIN_PAGES) & (F.col("m") == F.col("pages")) & (F.col("most") < 1e-9)
    # a large host's low branches are spread by path
    low = settle(salted_join(own.join(branches, "path").filter((F.col("most") < LOW) & (F.col("m") >= FEW_PAGES)), hosts, ["top"], F.col("path"))
                 .filter((F.col("m") >= MIN_PAGES) | everywhere).select("path", "parent"))
    return low.join(low.select(F.col("path").alias("parent")), "parent", "left_anti").select("path")


def _page_paths(batches):
    """(row, path) of the paths that lead to a page's blocks."""
    for b in batches:
        found = [_unpack(x) for x in b.column("packed").to_pylist()]
        sizes = [len(x[0]) for x in found]
        rows = np.repeat(b.column("row").to_numpy(), sizes)
        yield pa.RecordBatch.from_arrays([pa.array(rows), pa.array(np.concatenate([x[0] for x in found]) if found else rows)], names=["row", "path"])


def _extract(batches):
    for b in batches:
        texts = []
        for blob, noise in zip(b.column("packed").to_pylist(), b.column("noise").to_pylist()):
            paths, parents, _, _, _, at, kept = _unpack(blob)
            if noise:
                gone = np.isin(paths, np.array(noise, np.int64)).tolist()
                for k, up in enumerate(parents.tolist()):  # parents come first
                    gone[k] = gone[k] or (up >= 0 and gone[up])
                # a page of nothing else keeps it
                kept = [t for k, t in zip(at.tolist(), kept) if not gone[k]] or kept
            texts.append("\n".join(kept))
        rest = [c for c in b.schema.names if c not in ("packed", "noise")]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], names=[*rest, "text", "n_chars"])


def _rows(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pick(pages, page_id=id_col, url=url_col, html=html_col).select(
        F.xxhash64("page_id", "url", "html").alias("row"), "page_id", "url", host.alias("host"),
        F.coalesce("html", F.lit("")).cast("binary").alias("raw"))


PARSED = [T.StructField("top", T.LongType()), T.StructField("page", T.LongType()), T.StructField("packed", T.BinaryType())]


def parse_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """row (its hash), top (the host's), page (the texts') and packed tree entries of every page; checkpointed."""
    rows = _rows(pages, id_col, url_col, html_col).select("row", "host", "raw")
    return settle(rows.mapInArrow(_parse_pages(True), T.StructType([rows.schema["row"], *PARSED])))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    parsed = parse_pages(pages, id_col, url_col, html_col)
    noise = (salted_join(parsed.select("row", "packed").mapInArrow(_page_paths, "row long, path long"), site_noise(parsed), ["path"], F.col("row"))
             .groupBy("row").agg(F.collect_set("path").alias("noise")))  # rows equal in all are one page
    rows = _rows(pages, id_col, url_col, html_col)
    blocks = rows.mapInArrow(_parse_pages(False), T.StructType([rows.schema["row"], rows.schema["page_id"], rows.schema["url"], *PARSED]))
    joined = blocks.join(noise, "row", "left").select("page_id", "url", "packed", "noise")
    schema = T.StructType([joined.schema["page_id"], joined.schema["url"],
                           T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])
    return joined.mapInArrow(_extract, schema)


def op10_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))

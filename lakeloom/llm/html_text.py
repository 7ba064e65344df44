"""Main text of web pages: marked regions, and differencing against the page with the nearest address."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeloom.llm.arrow import map_batches, utf8
from lakeloom.llm.bitmap import marked_in, maybe_in
from lakeloom.llm.mix_sources import POSITION_BITS
from lakeloom.session import materialize

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Their content is no markup and ends at their own end tag only.
RAW = set("script style textarea title xmp".split())
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol optgroup option p pre section "
    "summary table tbody tfoot thead tr ul".split()
)
DROPPED = set(
    "script style head title noscript template nav footer aside form button select textarea input iframe object "
    "svg canvas dialog menu xmp audio video".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search form dialog alert alertdialog menu".split())
# Class and id names, or their first or last parts, that mark what is no article.
DROPPED_NAMES = set(
    "ad ads advert advertisement adverts advertising banner bottombar breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disclaimer disqus footer login masthead menu modal nav navbar navigation newsletter notice "
    "notices pagination popup promo related replies responses reviews share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar topbar widget".split()
)
# Pairs of parts that mark an element like the names above.
DROPPED_PAIRS = {("top", "bar"), ("bottom", "bar"), ("side", "bar"), ("reader", "comments"), ("user", "comments")}
# First parts of names that tell of a layout or state, and names of a wrapper of the whole.
STATES = set("has is no not with without".split())
# Words that are also the last part of other names (share-price, related-work) or mean something else in an article (a
# notice of law): they mark an element only alone, as the last part, or before one of KINDS.
LOOSE = set(
    "comment consent copyright disclaimer login menu modal notice notices promo related reviews share social sponsor".split()
)
KINDS = set(
    "area bar block box button buttons container content form icons inner item items link links list menu overlay panel "
    "posts section stories thread wrapper".split()
)
# Adverts are dropped wherever they are marked.
ADVERTS = set("ad ads advert advertisement adverts advertising sponsored".split())
# Elements that hold the text itself.
TEXT_ELEMENTS = set(
    "a b blockquote code dd dt em figcaption h1 h2 h3 h4 h5 h6 i li p pre q small span strong td th u".split()
)
# An end that is left out: opening the first closes an open one of the second.
CLOSES = {"li": {"li"}, "p": {"p"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "option": {"option"}}
# Elements that an end left out does not reach over.
WALLS = set("article aside body div footer form header main nav ol section table ul".split())
ENDS_P = BLOCKS - {"body", "html", "head", "option", "optgroup", "tbody", "thead", "tfoot", "tr", "caption"}

# Where a line stands: in an article, in other main content, elsewhere.
ARTICLE, MAIN, ELSEWHERE = 2, 1, 0
# How an element is dropped: by its names, which an article or main element in it overrides, or by what it is.  Names
# that mark text in an article only make it doubtful: it goes if it is the site's.
DOUBTFUL, BY_NAME, BY_KIND = 1, 2, 3
# A line on different pages of so many paths of a host is the site's.
SITE_PATHS = 3
# Pages are near copies, and count as one, if so many of SKETCH smallest line hashes agree: about four lines of five.
SKETCH, ALIKE = 64, 42


def _attributes(raw: str) -> dict[str, str]:
    found = {}
    for name, value in ATTRIBUTE.findall(raw):
        found.setdefault(name.lower(), unescape(value.strip("\"'")))
    return found


def _marks(names: str) -> set[str]:
    """The words in class or id names, or whole names, that mark an element as no article."""
    found = set()
    for name in names.split():
        parts = [part for part in re.split(r"[_-]+", name) if part]
        if not parts or not STATES.isdisjoint(parts[:-1]):
            continue
        first, last = parts[0], parts[-1]
        if last in DROPPED_NAMES:
            found.add(last)
        elif first in DROPPED_NAMES and (first not in LOOSE or last in KINDS or last.isdigit()):
            found.add(name if first in LOOSE else first)  # a comment-list is certain
        elif tuple(parts[:2]) in DROPPED_PAIRS:
            found.add("".join(parts[:2]))
    return found


def _region(tag: str, attributes: dict[str, str], level: int) -> tuple[int, int]:
    """How an element is dropped (0: not), and the level of its content."""
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower()
    role = attributes.get("role", "").lower()
    style = attributes.get("style", "").replace(" ", "").lower()
    by_kind = (
        tag in DROPPED
        or (tag == "header" and level < ARTICLE)
        or role in DROPPED_ROLES
        or "hidden" in attributes
        or attributes.get("aria-hidden", "").lower() == "true"
        or "display:none" in style
    )
    wrapper = tag in ("body", "html", "main", "article") or role in ("main", "article")
    drop = BY_KIND if by_kind else 0
    if not drop and not wrapper and (marks := _marks(names)):
        # In an article a loose word, or any but an advert's on an element of text, proves nothing.
        weak = marks.isdisjoint(ADVERTS) and (marks <= LOOSE or tag in TEXT_ELEMENTS)
        drop = DOUBTFUL if level == ARTICLE and weak else BY_NAME
    if tag == "article" or role == "article" or attributes.get("itemprop", "").lower() == "articlebody":
        level = ARTICLE
    elif tag == "main" or role == "main":
        level = max(level, MAIN)
    return drop, level


class _Open:
    """The open elements of a page, with the places of each tag, so that no search walks over them."""

    def __init__(self) -> None:
        self.elements: list[tuple[str, int, int]] = [("", 0, ELSEWHERE)]  # tag, how dropped, level
        self.places: dict[str, list[int]] = {}
        self.walls = [0]

    def push(self, tag: str, drop: int, level: int) -> None:
        self.places.setdefault(tag, []).append(len(self.elements))
        if tag in WALLS:
            self.walls.append(len(self.elements))
        self.elements.append((tag, drop, level))

    def cut(self, depth: int) -> bool:
        """Close the elements from a depth on; whether the level changes on the way."""
        changes = False
        while len(self.elements) > depth:
            tag, _, level = self.elements.pop()
            self.places[tag].pop()
            if tag in WALLS:
                self.walls.pop()
            changes |= level != self.elements[-1][2]
        return changes

    def last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else 0


def page_lines(html: str) -> list[tuple[str, int]]:
    """(text, level) of each block that is not in a dropped region, in page order."""
    return [(text, level) for text, level, _ in marked_lines(html)]


def marked_lines(html: str) -> list[tuple[str, int, bool]]:
    """(text, level, doubtful) of each block that is not in a dropped region, in page order, in one pass."""
    lines: list[tuple[str, int, bool]] = []
    parts: list[str] = []
    stack = _Open()
    doubt = False

    def flush() -> None:
        nonlocal doubt
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                lines.append((text, stack.elements[-1][2], doubt))
            parts.clear()
        doubt = False

    at = 0
    while True:
        found = TOKEN.search(html, at)
        text = html[at : found.start() if found else len(html)]
        if text and stack.elements[-1][1] <= DOUBTFUL:
            if not parts:
                doubt = True
            parts.append(text)
            # A line is doubtful if all of its text is.
            doubt &= stack.elements[-1][1] == DOUBTFUL or not text.strip()
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if tag in BLOCKS:
            flush()
        if tag in ("br", "td", "th"):
            parts.append(" ")
            doubt |= len(parts) == 1
        if found[1]:
            if depth := stack.last(tag):
                # The level may change at an end that closes others with it: what stands before is a line of its own.
                if any(level != stack.elements[-1][2] for _, _, level in stack.elements[depth - 1 :]):
                    flush()
                stack.cut(depth)
            continue
        ends = CLOSES.get(tag, set()) | ({"p"} if tag in ENDS_P else set())
        depth = max(map(stack.last, ends), default=0)
        if depth > stack.walls[-1]:
            stack.cut(depth)
        if tag in VOID:
            continue
        if tag in RAW:
            end = re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(html, at)
            at = end.start() if end else len(html)
        _, dropped, level = stack.elements[-1]
        attributes = _attributes(found[3]) if found[3].strip(" /") else {}
        drop, inner = _region(tag, attributes, level)
        if inner != level:
            flush()
            if level == ELSEWHERE and dropped == BY_NAME:
                dropped = 0
        if not (found[3].endswith("/") and tag not in BLOCKS and tag not in RAW):
            stack.push(tag, max(dropped, drop), inner)
    flush()
    return lines


def kept_region(lines: list[tuple[str, int, bool]]) -> tuple[list[bool], list[bool]]:
    """Which lines are the page's text by their place, and which of these go if they are the site's.

    A page with an article or main element gives what stands in them: in main all of it, with the articles there, as the
    article may be a teaser and the text around it the page's.  What stands in an article goes only if it is doubtful.
    """
    top = max((level for _, level, _ in lines), default=ELSEWHERE)
    inside = [level > ELSEWHERE if top > ELSEWHERE else True for _, level, _ in lines]
    mixed = top == ELSEWHERE or any(level == MAIN for _, level, _ in lines) and top == ARTICLE
    return inside, [own and (doubtful or mixed and level < ARTICLE) for own, (_, level, doubtful) in zip(inside, lines)]


def _vectors(a: list[int], b: list[int]) -> list[int]:
    """Bit vectors after each element of ``a``: a zero at j marks that b[j] makes the common subsequence longer."""
    where: dict[int, int] = {}
    for j, value in enumerate(b):
        where[value] = where.get(value, 0) | 1 << j
    full = (1 << len(b)) - 1
    vector, out = full, []
    for value in a:
        hit = vector & where.get(value, 0)
        vector = ((vector + hit) | (vector - hit)) & full
        out.append(vector)
    return out


def _prefix_lengths(vector: int, n: int) -> np.ndarray:
    raw = np.frombuffer(vector.to_bytes((n + 7) // 8, "little"), dtype=np.uint8)
    return np.r_[0, np.cumsum(1 - np.unpackbits(raw, bitorder="little")[:n].astype(np.int64))]


def common_subsequence(a: list[int], b: list[int], bits: int = 1 << 28) -> list[int]:
    """Positions in ``a`` of a longest common subsequence with ``b``.

    Values that only one side has are left out first.  The rest goes by bit vectors, which are kept for the way back
    while they take at most ``bits``; longer sequences are halved where their parts' lengths add up to most.
    """
    both = set(a) & set(b)
    at = [i for i, value in enumerate(a) if value in both]
    a, b = [a[i] for i in at], [value for value in b if value in both]
    if not a:
        return []
    if len(a) * len(b) <= bits or len(a) == 1:
        vectors = [(1 << len(b)) - 1, *_vectors(a, b)]
        j, out = len(b), []
        for i in range(len(a), 0, -1):
            # The j first elements of b have as long a subsequence without a[i - 1]: skip it.
            mask = (1 << j) - 1
            if (vectors[i] & mask).bit_count() == (vectors[i - 1] & mask).bit_count():
                continue
            out.append(i - 1)
            while b[j - 1] != a[i - 1]:
                j -= 1
            j -= 1
        return [at[i] for i in reversed(out)]
    half = len(a) // 2
    front = _prefix_lengths(_vectors(a[:half], b)[-1], len(b))
    back = _prefix_lengths(_vectors(a[half:][::-1], b[::-1])[-1], len(b))[::-1]
    cut = int((front + back).argmax())
    found = common_subsequence(a[:half], b[:cut], bits)
    found += [half + i for i in common_subsequence(a[half:], b[cut:], bits)]
    return [at[i] for i in found]


def _segments_shared(path: str, other: str) -> int:
    n = 0
    for n, (a, b) in enumerate(zip(path.split("/"), other.split("/")), 1):
        if a != b:
            return n - 1
    return n


def site_lines(pages: DataFrame, asked: DataFrame) -> DataFrame:
    """The lines of ``asked`` (host, hash) that are on pages of SITE_PATHS paths, none a near copy of another, with ``site``.

    Pages (host, path, hashes) are compared by sketches, the smallest of their line hashes under SKETCH orders.  Each
    line has two pages as examples, its first and its last by sketch.  It is the site's if, beside either, enough paths
    have pages unlike it.  So a line of near copies is not, on however many paths.
    """
    sketch = F.transform(
        F.sequence(F.lit(1), F.lit(SKETCH)), lambda i: F.array_min(F.transform("hashes", lambda h: F.xxhash64(h, i)))
    )
    standing = maybe_in(pages.select("host", "path", "hashes"), asked, "host").withColumn("sketch", sketch)
    standing = maybe_in(standing.select("host", "path", "sketch", F.explode("hashes").alias("hash")), asked, "host", "hash")
    standing = materialize(standing, "standing")
    ends = standing.groupBy("host", "hash").agg(F.min("sketch").alias("one"), F.max("sketch").alias("two"))
    compared = standing.join(materialize(ends, "examples"), ["host", "hash"])

    def unlike(example: str) -> Column:
        same = F.filter(F.zip_with("sketch", example, lambda a, b: a == b), lambda same: same)
        return F.when(F.size(same) < ALIKE, F.col("path"))

    other = compared.select("host", "hash", unlike("one").alias("one"), unlike("two").alias("two"))
    sides = [F.struct(F.lit(n).alias("n"), F.col(name).alias("path")) for n, name in enumerate(("one", "two"))]
    other = other.select("host", "hash", F.explode(F.array(*sides)).alias("o"))
    other = other.where("o.path is not null").select("host", "hash", "o.n", "o.path").distinct()
    paths = other.groupBy("host", "hash", "n").count().where(F.col("count") >= SITE_PATHS - 1)
    found = paths.groupBy("host", "hash").count().where(F.col("count") == 2)
    return materialize(found.select("host", "hash", F.lit(True).alias("site")), "site")


def extract_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by two line ends, "" if none), n_chars, n_deleted.

    Menus, headers, footers, sidebars, notices, adverts, forms, comments of readers and hidden parts are known by
    element, role, class or id and go first, scripts, styles and markup as well; in an article or main element they go only by
    what is certain, and text that merely bears such a name is doubtful.  A page with an article or main element gives
    what stands in these, other pages all that is left.

    Then pages are differenced.  Pages of a host with equal lines count as one, with the first of their paths.  A page
    that has lines to lose is aligned, line by line, with the page next to it: of the neighbours by path within the host, the one
    that shares more path segments, the earlier one if both do.  Lines of a longest common subsequence of the two are
    deleted if they are the site's: on pages of at least SITE_PATHS paths of the host, where near copies of one page
    count as one.
    On a page without article and main the others are deleted, too, unless they are more than half of what is left without
    the site's lines: then the two are near copies, and what they share may be the article.  In an article only
    doubtful lines can be lost, and in a main element with an article also those outside of the article; the
    rest stays whole though other pages may hold it too.  ``n_deleted`` counts the lines deleted as shared.

    A NULL or empty page has text "".  A NULL address belongs to a host of its own.  Rows that repeat a page give the
    same text.  Other columns are ignored; an empty table gives no rows.

    The order by host, path and id is made over line hashes only, range by range, so that a host with many pages
    spreads over many tasks, and neighbours are found by position.  Only pages that have lines to lose are joined to
    their neighbours.  Pages are read again for their text, and only those that lose lines are moved for it.
    """
    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").alias("url"),
        F.col(f"`{html_col}`").alias("html"),
    )
    # What a page is known by: rows that agree in it are equal.
    rows = rows.select("*", F.xxhash64(F.coalesce("page_id", F.lit(0)), "url", "html").alias("page"))

    def hash_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            bare, hashes, loose, same = [], [], [], []
            for html in utf8(batch.column(2)):
                lines = marked_lines(html.decode("utf-8", "replace"))
                bare.append(not any(level > ELSEWHERE for _, level, _ in lines))
                hashes.append([xxhash.xxh3_64_intdigest(text) >> 1 for text, _, _ in lines])
                loose.append(np.flatnonzero(kept_region(lines)[1]))
                same.append(xxhash.xxh3_128_digest(np.array([*hashes[-1], -1, *loose[-1]], dtype=np.int64).tobytes()))
            yield {
                "page_id": batch.column(0), "url": batch.column(1), "page": batch.column(3), "bare": bare,
                "hashes": hashes, "loose": loose, "same": same,
            }

    schema = "page_id long, url string, page long, bare boolean, hashes array<long>, loose array<long>, same binary"
    hashed = map_batches(rows, hash_lines, schema).withColumn("row", F.monotonically_increasing_id())
    hashed = materialize(hashed, "lines")
    # Scheme, host and path of an address.
    parts = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^?#]*)"
    keyed = hashed.select(
        "row",
        "page",
        "page_id",
        "bare",
        "hashes",
        "loose",
        "same",
        F.coalesce(F.lower(F.regexp_extract("url", parts, 1)), F.lit("")).alias("host"),
        F.coalesce(F.regexp_extract("url", parts, 2), F.lit("")).alias("path"),
    )
    # Equal lines of a host: the first of the pages stands for all.
    first = F.min(F.struct("path", "page_id", "page", "row")).alias("first")
    firsts = keyed.groupBy("host", "same").agg(first)
    keyed_once = keyed.join(materialize(firsts.select(F.col("first.row").alias("row")), "firsts"), "row")
    order = ["host", "path", "page_id", "page"]
    spot = F.monotonically_increasing_id()
    placed = keyed_once.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(
        placed.select(
            "*", F.shiftright(spot, POSITION_BITS).alias("part"),
            spot.bitwiseAND((1 << POSITION_BITS) - 1).alias("position"),
        ),
        "placed",
    )
    counts = placed.groupBy("part").count()  # one row per partition written
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start"))
    numbered = placed.join(F.broadcast(starts), "part").select(
        "row", "bare", "host", "path", "same", "hashes", "loose", (F.col("start") + F.col("position")).alias("at")
    )
    numbered = materialize(numbered, "numbered")

    losing = numbered.where(F.size("loose") > 0)
    sides = F.explode(F.array(F.col("at") - 1, F.col("at") + 1)).alias("at")
    wanted = materialize(losing.select(sides).distinct(), "wanted")
    near = materialize(maybe_in(numbered, wanted, "at").select("at", "host", "path", "hashes"), "near")

    def beside(step: int, name: str) -> DataFrame:
        return near.select((F.col("at") - step).alias("at"), F.struct("host", "path", "hashes").alias(name))

    paired = losing.join(beside(-1, "previous"), "at", "left").join(beside(1, "following"), "at", "left")

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            out: dict = {"row": [], "host": [], "same": [], "bare": [], "line": [], "hash": [], "shared": []}
            for page in batch.to_pylist():
                beside = [p for p in (page["previous"], page["following"]) if p and p["host"] == page["host"]]
                partner = max(beside, key=lambda p: _segments_shared(page["path"], p["path"]), default=None)
                shared = set(common_subsequence(page["hashes"], partner["hashes"]) if partner else ())
                if not shared.isdisjoint(page["loose"]):
                    n = len(page["loose"])
                    for name in ("row", "host", "same", "bare"):
                        out[name] += [page[name]] * n
                    out["line"] += page["loose"]
                    out["hash"] += [page["hashes"][line] for line in page["loose"]]
                    out["shared"] += [line in shared for line in page["loose"]]
            yield out

    schema = "row long, host string, same binary, bare boolean, line long, hash long, shared boolean"
    aligned = materialize(map_batches(paired, align, schema), "aligned")
    site = site_lines(numbered, materialize(aligned.select("host", "hash").distinct(), "asked"))
    judged = aligned.join(site, ["host", "hash"], "left").withColumn("site", F.coalesce("site", F.lit(False)))
    left = ~F.col("site")
    judged = judged.groupBy("row").agg(
        F.min("host").alias("host"),
        F.min("same").alias("same"),
        F.min("bare").alias("bare"),
        F.count_if(left).alias("left"),
        F.count_if(left & F.col("shared")).alias("left_shared"),
        F.collect_list(F.when(F.col("shared"), F.col("line"))).alias("shared"),
        F.collect_list(F.when(F.col("shared") & F.col("site"), F.col("line"))).alias("shared_site"),
    )
    site_only = ~F.col("bare") | (F.col("left_shared") * 2 > F.col("left"))
    gone = judged.select("host", "same", F.when(site_only, F.col("shared_site")).otherwise(F.col("shared")).alias("gone"))
    gone = materialize(gone.where(F.size("gone") > 0), "gone")
    # Equal pages lose the same lines.
    losers = keyed.where(F.size("loose") > 0).select("host", "same", "page").distinct()
    losers = materialize(losers, "losers").join(gone, ["host", "same"])
    aligned = materialize(losers.select("page", F.col("gone").alias("shared")), "losing")
    pages_marked = marked_in(rows, aligned, "page")
    losing = pages_marked.where("__maybe").join(aligned, "page", "left").select("page_id", "url", "html", "shared")
    others = pages_marked.where("not __maybe").select(
        "page_id", "url", "html", F.lit(None).cast("array<long>").alias("shared")
    )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        for batch in batches:
            texts, deleted = [], []
            for html, gone in zip(utf8(batch.column(2)), batch.column(3).to_pylist()):
                lines, gone = marked_lines(html.decode("utf-8", "replace")), set(gone or ())
                inside = kept_region(lines)[0]
                kept = [line[0] for n, line in enumerate(lines) if inside[n] and n not in gone]
                texts.append("\n\n".join(kept))
                deleted.append(len(gone))
            yield {
                "page_id": batch.column(0), "url": batch.column(1), "text": texts, "n_chars": list(map(len, texts)),
                "n_deleted": deleted,
            }

    schema = "page_id long, url string, text string, n_chars long, n_deleted long"
    return map_batches(losing.unionByName(others), assemble, schema)

"""Main text of web pages by nearest-URL page differencing.

Pages are cut into text blocks. Within each host pages are sorted by URL path,
and every page is paired with its nearest neighbours there; blocks are aligned
by longest common subsequence and what is shared is deleted: menus, footers and
notices come back from page to page, the article does not. Three things keep
differencing from doing harm or missing what a single page shows:

* Elements that are no article by their own declaration (navigation, header,
  footer, sidebar, form, script, style, adverts, comments by class or id) go.
* Pages of a host with the same blocks are one page here, and all get its result.
  A neighbour is nearly a copy, not a template sibling, when one of the two has
  almost no text that the other lacks; it is passed over for the next one.
* Where a page marks its article (``article`` or ``main``), a block inside it
  goes only when all but one of its neighbours share it; elsewhere one is enough.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerstar.llm.common import pack, sliced, store, unpack

#: Neighbours on each side in URL order.
REACH = 2
#: Two pages are nearly copies when what one of them does not share is at most so many characters, and this share of it.
OWN, OWN_SHARE = 40, 0.05
#: Rows of a block key's copies are dealt over so many tasks.
SALTS = 64
#: Pages aligned together: a range of this many in URL order, with REACH more on each side.
RANGE = 128

#: Element names.
RAW = frozenset("script style noscript template svg iframe object textarea title head".split())
DROPPED = frozenset("nav footer aside form button select dialog menu canvas audio video".split()) | RAW
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr"
    " math maction menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics annotation".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of the first closes an open one of the second.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"}}
BLOCK_ENDS_P = frozenset("div ul ol table section article main header footer nav aside form h1 h2 h3 h4 h5 h6 blockquote pre hr".split())
#: A whole token of a class or an id.
NAMED = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|notices?|alert|popup|modal|newsletter|subscribe|share|sharing|social|sidebar"
    r"|side-bar|menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|comments?|replies|related|recommend\w*|login|signup|search)[_-]?\d*",
    re.IGNORECASE,
)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu".split())
TAG = re.compile(r"<(?:(/?)([A-Za-z][^\s/>]*)((?:=\s*+\"[^\"]*\"|=\s*+'[^']*'|[^<>])*+)>|!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z))", re.DOTALL)
#: One attribute and its value; a quote only opens a value behind an equals sign.
ATTRIBUTE = re.compile(r"([^\s/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'][^\s]*)))?")
BLANK = re.compile(r"\s+")


def _declared(name: str, attributes: str, inside: bool) -> tuple[bool, bool]:
    """Whether an element says that it is no part of the article: by its own name, role or style; by class or id."""
    if name in DROPPED or name == "header" and not inside:
        return True, False
    if not attributes or name in ("html", "body", "article", "main"):
        return False, False
    named = False
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key in ("class", "id"):
            named = named or any(NAMED.fullmatch(token) for token in value.split())
        if key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True, False
        if key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True, False
    return False, named


def blocks(page: str | None) -> list[tuple[str, bool, bool]]:
    """(text, dropped by declaration, inside article or main) of every block in page order; blank blocks are left out.

    An element named by class or id is no declaration when it holds an article, main or most of the text that is left,
    or when it is inline and its block has other words, too: a block is never split or cut for the name of a part of
    a sentence. Inline elements that are not shown (hidden, aria-hidden, style) leave their block, which stays one.
    """
    out: list[tuple[str, bool, bool, int]] = []
    if not page:
        return []
    stack: list[tuple[str, bool, bool, int]] = []  # element, dropped, inside, nearest named element around it
    parts: list[tuple[str, bool, int]] = []  # text, dropped and nearest named element there
    dropped = inside = mixed = False  # mixed: an inline element with a say began or ended in this block
    # Of each named element the nearest one around it, and whether it holds an article; 0 stands for none.
    around, outer, holds = 0, [0], [True]

    def flush() -> None:
        nonlocal mixed
        if not parts:
            return
        # The first part lies before any inline element that begins in this block.
        (_, gone, level), shown = parts[0], parts
        if mixed:
            words = [p for p in parts if p[0] and not p[0].isspace()]
            gone = gone or all(p[1] for p in words)
            shown = parts if gone else [p for p in parts if not p[1]]
            named = [p[2] for p in words if gone or not p[1]]
            if named and level not in named:
                level = named[0]
        text = "".join([p[0] for p in shown]).strip()
        parts.clear()
        mixed = False
        if text:
            text = BLANK.sub(" ", html.unescape(text)).strip()
        if text:
            out.append((text, gone, inside, level))

    at, lower = 0, None
    while True:
        m = TAG.search(page, at)
        parts.append((page[at : m.start()] if m else page[at:], dropped, around))
        if not m:
            break
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if name in INLINE:
            if name == "br":
                parts.append((" ", dropped, around))
            declared, named = _declared(name, m[3], inside) if name != "br" and not m[1] and name not in VOID and m[3] else (False, False)
            nested = not m[1] and name not in VOID and stack and stack[-1][0] == name
            if declared or named or nested:
                mixed = True
                stack.append((name, dropped, inside, around))
                dropped = dropped or declared
                if named:
                    outer.append(around)
                    holds.append(False)
                    around = len(outer) - 1
            elif m[1] and stack and stack[-1][0] == name:
                mixed = True
                _, dropped, inside, around = stack.pop()
            continue
        flush()
        if m[1]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    _, dropped, inside, around = stack[k]
                    del stack[k:]
                    break
            continue
        if name in RAW and not (m[3] or "").endswith("/"):
            if name != "head":
                lower = page.lower() if lower is None and len(page.lower()) == len(page) else lower or page
                end = lower.find("</" + name, at)
                at = len(page) if end < 0 else end
                continue
        closes = CLOSES.get(name, {"p"} if name in BLOCK_ENDS_P else ())
        while stack and stack[-1][0] in closes:
            _, dropped, inside, around = stack.pop()
        if name in VOID or (m[3] or "").rstrip().endswith("/"):
            continue
        if name == "body":
            stack.clear()
            dropped, inside, around = False, False, 0
        stack.append((name, dropped, inside, around))
        declared, named = _declared(name, m[3] or "", inside)
        dropped = dropped or declared
        if named:
            outer.append(around)
            holds.append(False)
            around = len(outer) - 1
        if name in ("article", "main"):
            inside = True
            holds[around] = True
    flush()
    size = [0] * len(outer)
    for text, gone, _, k in out:
        if not gone:
            size[k] += len(text)
    for k in range(len(outer) - 1, 0, -1):
        size[outer[k]] += size[k]
        holds[outer[k]] = holds[outer[k]] or holds[k]
    named_out = [False] * len(outer)
    for k in range(1, len(outer)):
        named_out[k] = named_out[outer[k]] or not holds[k] and 2 * size[k] <= size[0]
    return [(text, gone or named_out[k], within) for text, gone, within, k in out]


def split_url(url: str | None) -> tuple[str, str]:
    """Host (lower case, no user, port or www.) and path (no query or fragment, no .html or / at the end)."""
    rest = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*://", "", url or "")
    host, _, path = re.split(r"[?#]", rest, maxsplit=1)[0].partition("/")
    return re.sub(r"^www\.|:\d+$", "", host.rpartition("@")[2].lower()), re.sub(r"(\.html?|/)+$", "", path)


#: Bits of the rows kept to trace a common subsequence back; longer tables are halved first.
TRACE_BITS = 1 << 28


def _rows(a: list, b: list) -> Iterator[int]:
    """For each line of ``a`` the row of the table of common lengths: a zero bit where it grows along ``b``."""
    places: dict = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for x in a:
        hit = row & places.get(x, 0)
        row = (row + hit | row - hit) & full
        yield row


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` and every prefix of ``b``."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):  # noqa: B007
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_subsequence(a: list, b: list) -> list[tuple[int, int]]:
    """Positions of a longest common subsequence.

    Rows of the table of common lengths are whole numbers, one bit a line of ``b``, so that pages of thousands of
    equal lines take no longer than others. A table of over TRACE_BITS is halved where both halves' lengths add up
    to the most, so memory stays bounded.
    """
    in_a, in_b = set(a), set(b)
    left, right = [i for i, x in enumerate(a) if x in in_b], [j for j, x in enumerate(b) if x in in_a]
    out: list[tuple[int, int]] = []
    todo = [(0, len(left), 0, len(right))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        x, y = [a[i] for i in left[a0:a1]], [b[j] for j in right[b0:b1]]
        if not x or not y:
            continue
        if len(x) > 1 and len(x) * len(y) > TRACE_BITS:
            half = len(x) // 2
            cut = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
            todo += [(a0 + half, a1, b0 + cut, b1), (a0, a0 + half, b0, b0 + cut)]
            continue
        rows, i, j, found = list(_rows(x, y)), len(x), len(y), []
        while i and j:
            if rows[i - 1] >> (j - 1) & 1:
                j -= 1
            elif i > 1 and not rows[i - 2] >> (j - 1) & 1:
                i -= 1
            else:
                i, j = i - 1, j - 1
                found.append((left[a0 + i], right[b0 + j]))
        out += found[::-1]
    return out


def shared_blocks(pages: list[tuple[str, np.ndarray, np.ndarray, np.ndarray]], at: int, reach: int = REACH) -> np.ndarray:
    """Blocks of ``pages[at]`` to delete. A page: host, block hashes, block lengths, flags (1: declared, 2: inside the article)."""
    host, hashes, sizes, flags = pages[at]
    kept = (flags & 1) == 0
    votes = np.zeros(len(hashes), dtype=int)

    def own(same: np.ndarray, sizes: np.ndarray, kept: np.ndarray) -> bool:
        """Whether a page has text of its own."""
        return int(sizes[~same & kept].sum()) > min(OWN, OWN_SHARE * int(sizes[kept].sum()))

    seen: set[bytes] = set()
    for step in (-1, 1):
        k, used = at + step, 0
        while 0 <= k < len(pages) and used < reach and abs(k - at) <= 2 * reach and pages[k][0] == host:
            other = pages[k]
            pairs = common_subsequence(hashes.tolist(), other[1].tolist())
            same, there = np.zeros(len(hashes), dtype=bool), np.zeros(len(other[1]), dtype=bool)
            same[[i for i, _ in pairs]] = True
            there[[j for _, j in pairs]] = True
            k += step
            if not (own(same, sizes, kept) and own(there, other[2], (other[3] & 1) == 0)) or other[1].tobytes() in seen:
                continue  # nearly a copy of this page, or of a neighbour already compared
            seen.add(other[1].tobytes())
            used += 1
            votes += same
    return votes >= np.where((flags & 2) > 0, max(1, 2 * reach - 1), 1)


def _keyed(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", "html", F.xxhash64("page_id", "url", "html").alias("row"))


def _deleted(pages: DataFrame, reach: int) -> DataFrame:
    """(row, gone: packed positions) of every page row: the blocks that differencing deletes."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html"):
            rows = []
            for url, text, row in zip(*(batch.column(n).to_pylist() for n in ("url", "html", "row")), strict=True):
                found = blocks(text)
                hashes = np.array([xxhash.xxh64_intdigest(t.encode("utf-8", "replace")) for t, _, _ in found], dtype=np.uint64)
                sizes = np.array([len(t) for t, _, _ in found], dtype=np.int64)
                flags = np.array([d + 2 * i for _, d, i in found], dtype=np.int8)
                rows.append((*split_url(url), url or "", row, pack(hashes, sizes, flags)))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["host", "path", "url", "row", "lines"])

    lines = pages.mapInArrow(parse, "host string, path string, url string, row long, lines binary")
    lines = store(lines.dropDuplicates(["host", "path", "url", "row"]).withColumn("same", F.xxhash64("host", "lines")), "pages-lines")
    # One page for each host and blocks: copies would be each other's neighbours and show nothing.
    members = lines.select("row", "same")
    first = F.min(F.struct("path", "url", "row", "lines")).alias("f")
    lines = lines.groupBy("host", "same").agg(first, F.count(F.lit(1)).alias("copies")).select("host", "f.*", "same", "copies")
    # Global rank in URL order: position in a range partition plus the sizes of the partitions before it.
    placed = lines.repartitionByRange("host", "path", "url", "row").sortWithinPartitions("host", "path", "url", "row")
    placed = store(placed.select("*", F.spark_partition_id().alias("pid"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("pos")), "pages-order")
    counts = sorted((r["pid"], r["n"]) for r in placed.groupBy("pid").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for pid, n in counts:
        offsets.append((pid, total))
        total += n
    starts = pages.sparkSession.createDataFrame(offsets, "pid int, start long")
    edge = 2 * reach
    ranked = placed.join(F.broadcast(starts), "pid").withColumn("rank", F.col("start") + F.col("pos"))
    homes = F.array_distinct(F.array(*[F.floor((F.col("rank") + d) / RANGE).cast("long") for d in (-edge, 0, edge)]))
    spread = ranked.select("host", "row", "lines", "rank", "same", "copies", F.explode(homes).alias("home"))

    def align(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("rank")
        group = [(h, *unpack(x)) for h, x in zip(frame["host"], frame["lines"], strict=True)]
        own = [k for k, r in enumerate(frame["rank"].tolist()) if r // RANGE == key[0]]
        gone = [pack(np.flatnonzero(shared_blocks(group, k, reach)).astype(np.int32)) for k in own]
        return pd.DataFrame({**{c: frame[c].to_numpy()[own] for c in ("row", "same", "copies")}, "gone": gone})

    gone = store(spread.groupBy("home").applyInPandas(align, "row long, same long, copies long, gone binary"), "pages-groups")
    salted = gone.filter("copies > 1").select("same", "gone", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    copies = members.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(salted, ["same", "salt"]).select("row", "gone")
    return gone.filter("copies = 1").select("row", "gone").unionAll(copies).groupBy("row").agg(F.first("gone").alias("gone"))


def main_text(pages: DataFrame, reach: int = REACH) -> DataFrame:
    """(page_id, url, text, n_blocks, n_deleted) for every row of ``pages`` (page_id, url, html; others are ignored).

    text: the blocks that stay, in page order, joined by newlines; empty for null, empty or text-free pages. A null
    url is the empty one. Repeated rows get the same result each. Empty table: no rows.
    """
    keyed = _keyed(pages)
    gone = store(_deleted(keyed, reach), "pages-gone").withColumnRenamed("row", "gone_row")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html"):
            texts = []
            for page in batch.column("html").to_pylist():
                found = blocks(page)
                texts.append(pack(*[np.frombuffer(t.encode("utf-8", "replace"), np.uint8) for t, _, _ in found], np.array([d for _, d, _ in found], dtype=np.int8)))
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), batch.column("row"), pa.array(texts, pa.binary())], names=["page_id", "url", "row", "body"])

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n, lost = [], [], []
            for body, dead in zip(batch.column("body").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                *parts, dropped = unpack(body)
                keep = dropped == 0
                keep[unpack(dead)[0]] = False
                texts.append("\n".join(parts[k].tobytes().decode() for k in np.flatnonzero(keep).tolist()))
                n.append(len(parts))
                lost.append(int(len(parts) - keep.sum()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array(n, pa.int64()), pa.array(lost, pa.int64())],
                names=["page_id", "url", "text", "n_blocks", "n_deleted"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    bodies = keyed.mapInArrow(cut, f"page_id {kind}, url string, row long, body binary")
    joined = bodies.join(gone, F.col("row") == F.col("gone_row")).select("page_id", "url", "body", "gone")
    return joined.mapInArrow(join, f"page_id {kind}, url string, text string, n_blocks long, n_deleted long")

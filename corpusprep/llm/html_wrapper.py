"""Main text of web pages by wrappers inferred from the token streams of a host's pages.

A page is a stream of tag and text tokens. Adjacent equal blocks of one page fold into repeated groups; the streams of a
host are then aligned one after the other, and every mismatch is resolved: a block that one side repeats becomes a
repeated group, a block that one side lacks becomes an optional group, texts become slots. The result is a union-free
regular expression, the host's wrapper.

Each page is then matched against its host's wrapper, which tells the slot of each of its texts. A slot is a place in
the wrapper, labelled by the elements around it: content inside ``article`` or ``main``, dropped inside menus, headers,
footers, sidebars, notices, adverts, forms and reader comments, free elsewhere. A free slot whose text never changes over
a host's pages, at least three of which differ elsewhere, belongs to the template; the others hold data. The text of a page is what stands in its content slots, or,
in a page without them, in its free slots that hold data. Texts of a page that the wrapper does not cover have their
label as slot.

All pages take part. A host's distinct folded streams are merged as a tree, in groups of about ``width`` a round, so a
host with a third of all pages never meets in one task.
Null html is empty, a null URL is the host '', repeated rows are extracted row by row, an empty table gives an empty
table; of the input only the named columns are read.
"""

from __future__ import annotations

import hashlib
import html
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from itertools import groupby

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set("a abbr b bdi bdo big br cite code data dfn em font i img ins del kbd label mark q s samp small span strike "
             "strong sub sup time tt u var wbr".split())
EXCLUDED = set("nav header footer aside form head script style noscript template iframe button select option textarea "
               "title svg object dialog menu".split())
NAMED = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|sponsor(?:ed)?|promo|banner|cookies?|consent|notice|popup|modal|"
                   r"nav|navbar|navigation|menu|breadcrumbs?|header|footer|sidebar|comments?|respond|replies|share|sharing|"
                   r"social|related|newsletter|subscribe|pagination|toolbar)(?:$|[\s_-])", re.I)
ATTRS = r"""(?:"[^"]*"|'[^']*'|[^'">])*"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(script|style|title|textarea|noscript|iframe|template)\b{ATTRS}>.*?(?:</\1\b[^>]*>|\Z)"
    rf"|<(/?)([a-zA-Z][^\s/>]*)({ATTRS})>"
    r"|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^>]*\Z", re.S | re.I)
NAME = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
SPACE = re.compile(r"\s+")
CONTENT, FREE, DROPPED = "content", "free", "dropped"


def read_page(source: str) -> tuple[list[str], list[tuple[str, str, str]]]:
    """(token stream, blocks) of a page; a block is (slot, class of the slot, text)."""
    stream: list[str] = []
    blocks: list[tuple[str, str, str]] = []
    stack: list[tuple[str, str, str]] = []  # element, its name in slots, class of the slots in it
    text: list[str] = []

    def close() -> None:
        if text:
            joined = SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if joined:
                slot = "/".join(e[1] for e in stack if e[0] not in INLINE)
                blocks.append((slot, stack[-1][2] if stack else FREE, joined))
                stream.append("#")

    at = 0
    for m in TOKEN.finditer(source):
        if m.start() > at:
            text.append(source[at:m.start()])
        at = m.end()
        if m[3] is None:
            continue  # comment, declaration, script, style
        name = m[3].lower()
        if name in INLINE and not NAMED.search(" ".join(_names(m[4]))):
            if name == "br":
                text.append(" ")
            if name in VOID:
                continue
            if m[2]:
                if any(e[0] == name for e in stack):  # an inline element ends only itself
                    last = max(i for i, e in enumerate(stack) if e[0] == name)
                    if all(e[0] in INLINE for e in stack[last:]):
                        close() if stack[last][2] != (stack[last - 1][2] if last else FREE) else None
                        del stack[last]
            continue
        close()
        if m[2]:
            if any(e[0] == name for e in stack):
                while stack.pop()[0] != name:
                    pass
            stream.append(f"</{name}>")
            continue
        names = " ".join(_names(m[4]))
        if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option"):  # end tags that may be left out
            last = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), None)
            if last is not None and stack[last][0] == name:
                del stack[last:]
        elif name not in INLINE and stack:
            last = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), None)
            if last is not None and stack[last][0] == "p":  # a block ends an open paragraph
                del stack[last:]
        kind = stack[-1][2] if stack else FREE
        if name in EXCLUDED or (names and NAMED.search(names) and name not in ("article", "main", "body", "html")):
            kind = DROPPED
        elif kind != DROPPED and (name in ("article", "main") or re.search(r"\bmain\b", names)):
            kind = CONTENT
        label = name + ("." + re.sub(r"[\d/]+", "", names) if names else "")
        stream.append(f"<{label}>")
        if name not in VOID:
            stack.append((name, label, kind))
    if at < len(source):
        text.append(source[at:])
    close()
    return stream, blocks


def _names(attributes: str) -> list[str]:
    return [x for m in NAME.findall(attributes) for x in m if x] if attributes else []


# --- wrappers: lists of a token, ["?", items] (optional) or ["+", items] (repeated) ---------------------------------

def fold(items: list, widest: int = 32) -> list:
    """Adjacent equal blocks become repeated groups, the shortest blocks first, until nothing changes."""
    changed = True
    while changed:
        changed = False
        keys = [json.dumps(x) for x in items]
        for width in range(1, min(widest, len(items) // 2) + 1):
            i, out, seen = 0, [], False
            while i < len(items):
                block = keys[i:i + width]
                n = 1
                while len(block) == width and keys[i + n * width:i + (n + 1) * width] == block:
                    n += 1
                if n > 1 and not (width == 1 and isinstance(items[i], list)):
                    out.append(["+", items[i:i + width]])
                    i += n * width
                    seen = True
                elif n > 1:  # a repeated group next to itself, or an optional one, which may stand more than once
                    out.append(_once(items[i]))
                    i += n
                    seen = True
                else:
                    out.append(items[i])
                    i += 1
            if seen:
                items, changed = out, True
                break
    return items


def _once(group: list) -> list:
    """One group for several equal groups in a row."""
    return group if group[0] == "+" else ["?", group[1] if len(group[1]) == 1 and group[1][0][0] == "+" else [["+", group[1]]]]


def _take_groups(items: list, other: list) -> list:
    """Blocks of ``items`` that ``other`` repeats become repeated groups (a tag mismatch resolved as an iterator)."""
    for group in [x for x in other if isinstance(x, list) and x[0] == "+"]:
        block, out, i = group[1], [], 0
        while i < len(items):
            if items[i:i + len(block)] == block:
                out.append(group)
                i += len(block)
            else:
                out.append(items[i])
                i += 1
        items = fold(out)
    return items


def align(wrapper: list, stream: list) -> list:
    """The wrapper that also covers ``stream``."""
    if wrapper == stream:
        return wrapper
    a = _take_groups(wrapper, stream)
    b = _take_groups(stream, a)
    bare = [x[1] if isinstance(x, list) and x[0] == "?" else [x] for x in a]
    flat, owner = [], []  # optional groups take part with their items
    for i, xs in enumerate(bare):
        flat += xs
        owner += [i] * len(xs)
    keys = lambda xs: [json.dumps(x[1][0]) + "+" if isinstance(x, list) and x[0] == "+" else json.dumps(x) for x in xs]
    out: list = []

    def optional(items: list) -> None:
        if items:
            out.append(["?", items])

    def was_optional(i: int) -> bool:
        return isinstance(a[owner[i]], list) and a[owner[i]][0] == "?"

    for op, i, j, k, m in SequenceMatcher(None, keys(flat), keys(b), autojunk=False).get_opcodes():
        if op == "equal":
            for x, y, at in zip(flat[i:j], b[k:m], range(i, j)):
                both = ["+", align(x[1], y[1])] if isinstance(x, list) and x[0] == "+" and x != y else x
                if was_optional(at):
                    if at > i and owner[at] == owner[at - 1]:
                        out[-1] = ["?", out[-1][1] + [both]]
                    else:
                        optional([both])
                else:
                    out.append(both)
        else:
            for _, run in groupby(range(i, j), lambda at: owner[at] if was_optional(at) else -1):  # groups stay apart
                optional([flat[at] for at in run])
            optional(b[k:m] if op != "delete" else [])
    unique: list = []
    for x in out:  # a group stands once in a row
        if isinstance(x, list) and unique and unique[-1] in (x, _once(x)):
            unique[-1] = _once(x)
        else:
            unique.append(x)
    return unique


def merge_wrappers(shapes: list[str]) -> str:
    """One wrapper from folded streams or wrappers (JSON), in a fixed order."""
    wrapper: list | None = None
    for shape in sorted(set(shapes), key=lambda s: (len(s), s)):
        items = json.loads(shape)
        wrapper = items if wrapper is None else align(wrapper, items)
    return json.dumps(wrapper or [])


def as_expression(items: list) -> str:
    """A wrapper in the notation of regular expressions."""
    return "".join(x if isinstance(x, str) else f"({as_expression(x[1])}){x[0]}" for x in items)


# --- Spark ----------------------------------------------------------------------------------------------------------

def compile_wrapper(wrapper: str) -> list[tuple]:
    """Steps that match a wrapper (JSON): ("token", token), ("either", step, step) or ("end",)."""
    steps: list[tuple] = []

    def emit(items: list) -> None:
        for x in items:
            if isinstance(x, str):
                steps.append(("token", x))
            elif x[0] == "?":
                at = len(steps)
                steps.append(())
                emit(x[1])
                steps[at] = ("either", at + 1, len(steps))
            else:
                at = len(steps)
                emit(x[1])
                steps.append(("either", at, len(steps) + 1))

    emit(json.loads(wrapper))
    steps.append(("end",))
    return steps


def match(steps: list[tuple], stream: list[str]) -> list[int] | None:
    """For each text of the stream its slot, the number of the step that took it; None if the wrapper does not cover it.

    Each step is tried once at each place, so the time is at most their product.
    """
    n, tried, open_ = len(stream), set(), [(0, 0, None)]
    while open_:
        at, i, taken = open_.pop()
        while True:
            step = steps[at]
            if step[0] == "token":
                if i == n or stream[i] != step[1]:
                    break
                if step[1] == "#":
                    taken = (at, taken)
                at, i = at + 1, i + 1
            elif step[0] == "either":
                if (at, i) in tried:
                    break
                tried.add((at, i))
                open_.append((step[2], i, taken))
                at = step[1]
            elif i == n:
                out = []
                while taken:
                    out.append(taken[0])
                    taken = taken[1]
                return out[::-1]
            else:
                break
    return None


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: distinct folded streams of each host."""
    found: set[tuple[str, str]] = set()
    folded: dict[bytes, str] = {}

    def flush() -> pa.RecordBatch:
        rows = list(found)
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.string()) for i in range(2)], names=["host", "key"])

    for batch in batches:
        for host, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            stream, _ = read_page(source)
            digest = hashlib.md5("\n".join(stream).encode()).digest()
            if digest not in folded:
                if len(folded) > 20_000:
                    folded.clear()
                folded[digest] = json.dumps(fold(stream))
            found.add((host, folded[digest]))
        if len(found) > 50_000:
            yield flush()
    yield flush()


def host_of(url):
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1), F.lit("")))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html", width: int = 32,
                   broadcast_rows: int = 1_000_000) -> DataFrame:
    """(host, wrapper): the wrapper as JSON, merged in rounds of groups of about ``width`` streams or wrappers."""
    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    kind = T.StructType([T.StructField("host", T.StringType()), T.StructField("key", T.StringType())])

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [pdf["host"].iloc[0]], "key": [merge_wrappers(list(pdf["key"]))]})

    done, parts = None, rows.mapInArrow(_gather, "host string, key string").distinct().checkpoint()
    while True:
        sizes = parts.groupBy("host").agg(F.count(F.lit(1)).alias("n")).checkpoint()
        hosts, most = sizes.agg(F.count(F.lit(1)), F.max("n")).first()
        some = F.broadcast(sizes) if hosts <= broadcast_rows else sizes
        sized = parts.join(some, "host")
        single = sized.filter("n = 1").select("host", "key")
        done = single if done is None else done.unionByName(single)
        if (most or 0) <= 1:
            return done.withColumnRenamed("key", "wrapper")
        bucket = F.pmod(F.xxhash64("key"), F.ceil(F.col("n") / width))
        parts = (sized.filter("n > 1").select("host", "key", bucket.alias("bucket"))
                 .groupBy("host", "bucket").applyInPandas(merged, kind).checkpoint())


def _read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    kind = pa.struct([("text", pa.string()), ("free", pa.list_(pa.struct([("slot", pa.string()), ("text", pa.string())])))])
    compiled: dict[str, list[tuple]] = {}
    known: dict[tuple[str, bytes], list | None] = {}
    for pages in batches:
        out = []
        for source, wrapper in zip(pages.field(0).to_pylist(), pages.field(1).to_pylist()):
            stream, blocks = read_page(source)
            if wrapper not in compiled:
                if len(compiled) > 1_000:
                    compiled.clear()
                compiled[wrapper] = compile_wrapper(wrapper)
            key = (wrapper, hashlib.md5("\n".join(stream).encode()).digest())
            if key not in known:
                if len(known) > 20_000:
                    known.clear()
                known[key] = match(compiled[wrapper], stream)
            places = known[key] or [""] * len(blocks)
            slots = [(f"{place}:{label}", k, t) for place, (label, k, t) in zip(places, blocks)]
            main = [t for _, k, t in slots if k == CONTENT]
            free = [] if main else [{"slot": s, "text": t} for s, k, t in slots if k == FREE]
            out.append({"text": "\n".join(main), "free": free})
        yield pa.array(out, kind)


BLOCK = T.StructType([T.StructField("slot", T.StringType()), T.StructField("text", T.StringType())])
READ = F.arrow_udf(_read, T.StructType([T.StructField("text", T.StringType()), T.StructField("free", T.ArrayType(BLOCK))]))


def template_slots(read: DataFrame) -> DataFrame:
    """(host, template_slots) from pages (host, free): the slots with one text on three pages or more whose other slots differ.

    Pages with the same texts in the same slots, such as copies, count once, so any two that share a text differ elsewhere.
    """
    distinct = read.filter(F.size("free") > 0).groupBy("host", F.md5(F.to_json("free")).alias("page")).agg(F.first("free").alias("free"))
    each = distinct.select("host", "page", F.posexplode("free").alias("i", "b"))
    texts = (each.groupBy("host", "page", F.col("b.slot").alias("slot"))
             .agg(F.md5(F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("i", "b.text"))), lambda x: x["text"]))).alias("t")))
    slots = texts.groupBy("host", "slot").agg(F.count(F.lit(1)).alias("n"), F.min("t").alias("low"), F.max("t").alias("high"))
    return slots.filter("n >= 3 AND low = high").groupBy("host").agg(F.collect_list("slot").alias("template_slots"))  # a few slots of a template


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            broadcast_bytes: int = 8 << 20, salts: int = 32) -> DataFrame:
    """(id, url, text, wrapper) for every page; ``wrapper`` is the expression of the page's host.

    The wrappers are broadcast if their measured size is at most ``broadcast_bytes``; else they are joined by host and
    salt, so that a hot host is dealt out over ``salts`` tasks.
    """
    wrappers = infer_wrappers(pages, url_col, html_col).checkpoint()

    def with_host(rows: DataFrame, of_host: DataFrame, size) -> DataFrame:
        if (of_host.agg(F.sum(size + 64)).first()[0] or 0) <= broadcast_bytes:
            return rows.join(F.broadcast(of_host), "host", "left")
        salted = of_host.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        return (rows.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)).cast("int"))
                .join(salted, ["host", "salt"], "left").drop("salt"))

    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    page = READ(F.struct("html", "wrapper"))
    read = stored(with_host(rows, wrappers, F.length("wrapper")).select("page_id", "url", "host", page.alias("p"))
                  .select("page_id", "url", "host", "p.text", "p.free"))
    fixed = wrappers.join(template_slots(read), "host", "left").withColumn("template_slots", F.coalesce("template_slots", F.array())).checkpoint()
    joined = with_host(read, fixed, F.length("wrapper") + F.length(F.array_join("template_slots", ",")))
    slots = F.coalesce("template_slots", F.array())
    rest = F.array_join(F.transform(F.filter("free", lambda b: ~F.array_contains(slots, b["slot"])), lambda b: b["text"]), "\n")
    return joined.select("page_id", "url", F.when(F.size("free") > 0, rest).otherwise(F.col("text")).alias("text"), "wrapper")

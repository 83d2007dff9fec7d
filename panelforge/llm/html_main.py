"""Main text of web pages through site style trees.

Every page is cut into blocks: runs of text between block-level tags, each with its style
path (the block-level tags above it, with their classes and roles; ids tell pages apart, not styles, and digits count as one
sign). The pages of one host are merged into a style tree: for each path the texts found there and the layouts, that is the
sequences of child elements.

*Importance.* The effective number of texts of a path is the exponential of their entropy; its share in the path's blocks
is the content importance: near 0 where the same text returns on page after page, 1 where all differ. The effective number
of layouts over the element's occurrences is the presentation importance. A node with l layouts has the importance
(1 - GAMMA^l) * presentation + GAMMA^l * content, content being the mean over all blocks of its branch; a node without child elements
has that of its content. A branch is template if it and every node below it stay under the limit. Such branches
are removed from each page of the host. A bare paragraph, heading, item or cell (no class) is judged
with its container, so headings that return on every page stay with their text.

What the tree can't tell is left to tags and classes that say what they are (navigation, footers, forms, adverts, comments, ...):
hosts with few distinct bodies (three equal texts have importance 1/3), and adverts and comments that differ from page to page.
What is inside an article or main element is never removed for low importance, only by tags
and classes: repeated headings and copied articles are content. If a page has article or main elements, only blocks inside them
remain. A page that the tree would leave without any block keeps all that tags and classes leave.

All blocks and layouts are counted, template included, but each distinct body (the paths and texts that tags and classes leave)
once per host, by the page whose blocks have the least hash, so copies of a page weigh as one. Bodies are collapsed by
(host, body) map-side first, then counted by (host, path, text or layout) with map-side sums, so a host with a third of all
pages is summed up before it is shuffled. The removed paths are joined back on host and salt.

Defined results: null html is empty and gives an empty text; pages without url share the host ''; pages are
told apart by their place in the table, so rows that repeat a page_id give a row each; broken markup is
read leniently (unclosed blocks end with their parent); an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelforge.llm.common import materialize, pick, ship, slices

LIMIT = 0.3  # least importance
GAMMA = 0.9  # weight of content beside one more layout
SALT = 16
TEXT, LAYOUT = 0, 1  # what a counted hash stands for

RAW = "script|style|textarea|title|iframe|noembed|noframes|xmp|template"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>|<(?P<end>/)?(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>",
    re.S | re.I)
NAMED = re.compile(r"\b(?P<key>class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)

# Element kinds of HTML.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong "
                   "sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
DROPPED = frozenset("nav footer aside form button select noscript menu dialog svg canvas audio video object head".split())
HINTS = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert|adverts|advertisement|advertising|sponsor|sponsored|promo|promotion|banner|cookie|cookies|consent|gdpr|notice|notices|"
    r"alert|popup|modal|overlay|nav|navbar|navigation|menu|breadcrumb|breadcrumbs|sidebar|side|widget|widgets|footer|masthead|site-header|page-header|"
    r"comment|comments|respond|reply|replies|disqus|related|recommended|share|sharing|social|subscribe|subscription|newsletter|signup|login|search|"
    r"pagination|pager|skip|toolbar|tags|complementary|contentinfo)(?:$|[\s_-])", re.I)


# bare elements of running text; judged with their container
BARE = r"/(p|h[1-6]|li|dt|dd|tr|td|th|thead|tbody|tfoot|pre|blockquote)$"


def _names(attrs: str) -> tuple[str, str]:
    """(class, id and role names, those of the style alone), sorted."""
    every, style = set(), set()
    for m in NAMED.finditer(attrs):
        words = (m[2] or m[3] or m[4] or "").lower().replace("/", "_").split()
        every.update(words)
        if m["key"].lower() != "id":
            style.update(re.sub(r"\d+", "0", w) for w in words)
    return " ".join(sorted(every)), " ".join(sorted(style))


def blocks(html: str, layouts: list | None = None) -> list[tuple[str, bool, bool, str]]:
    """(path, inside an article or main, dropped by tag or class, text) of each block with text, in page order;
    (path, [styles of the children]) of each element goes into layouts."""
    out: list = []
    stack: list[tuple[str, str, bool, bool, list]] = []  # tag, path, article, dropped, children
    parts: list[str] = []

    def flush():
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            parts.clear()
            if text:
                _, path, article, dropped, _ = stack[-1] if stack else ("", "", False, False, [])
                out.append((path, article, dropped, text))

    at = 0
    for m in TOKEN.finditer(html):
        if m.start() > at:
            parts.append(html[at:m.start()])
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            parts.append(" ")
            continue
        if tag in INLINE:  # part of its block, unless it is marked as template
            marked = any(t == tag for t, *_ in stack) if m["end"] else bool(m["attrs"]) and HINTS.search(_names(m["attrs"])[0]) is not None
            if not marked:
                continue
        flush()
        if m["end"]:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
                if stack[i][0] in ("article", "main", "body") and tag not in ("html", "body", "main", "article"):
                    break
            continue
        if tag in VOID:
            continue
        # an open paragraph ends where a block begins; so do items before the next item
        while stack and (stack[-1][0] == "p" or stack[-1][0] in CLOSES.get(tag, ())):
            stack.pop()
        _, path, article, dropped, siblings = stack[-1] if stack else ("", "", False, False, [])
        names, style = _names(m["attrs"])
        inside = article or tag in ("article", "main") or "main" in names.split()
        gone = dropped or tag in DROPPED or (not article and "header" in (tag, *names.split())) or (tag not in ("html", "body", "main") and HINTS.search(names) is not None)
        if not m["attrs"].rstrip().endswith("/"):
            label = f"{tag}.{style}" if style else tag
            siblings.append(label)
            stack.append((tag, f"{path}/{label}", inside, gone, []))
            if layouts is not None:
                layouts.append((stack[-1][1], stack[-1][4]))
    if at < len(html):
        parts.append(html[at:])
    flush()
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", url or "", re.I)
    return m[1].lower() if m else ""


def style_counts(pages: DataFrame, lists: bool = True) -> DataFrame:
    """(host, path, kind, hash, n) of the texts and layouts of each host's distinct bodies."""
    def run(batches):
        from xxhash import xxh3_64_intdigest, xxh3_128_digest

        def number(text):
            return xxh3_64_intdigest(text.encode()) - (1 << 63)

        def digest(counts):
            return xxh3_128_digest(repr(sorted(counts.items())).encode())

        bodies: dict = {}
        held = 0
        for batch in slices(batches):
            for url, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                layouts: list = []
                found = blocks(page or "", layouts)
                left = Counter((path, number(text)) for path, _, dropped, text in found if not (lists and dropped))
                if not left:
                    continue
                every = Counter((path, TEXT, number(text)) for path, _, _, text in found)
                every.update((path, LAYOUT, number("/".join(children))) for path, children in layouts if children)
                key, full = (host_of(url), digest(left)), digest(every)
                if key not in bodies or full < bodies[key][0]:
                    held += len(every)
                    bodies[key] = full, [{"path": path, "kind": kind, "h": h, "n": n} for (path, kind, h), n in every.items()]
                if held > 50_000:
                    yield _bodies(bodies)
                    bodies, held = {}, 0
        if bodies:
            yield _bodies(bodies)

    found = pages.select("url", "html").mapInArrow(
        run, "host string, body binary, whole binary, blocks array<struct<path:string,kind:int,h:bigint,n:bigint>>")
    once = found.groupBy("host", "body").agg(F.min_by("blocks", "whole").alias("blocks"))
    return once.select("host", F.inline("blocks")).groupBy("host", "path", "kind", "h").agg(F.sum("n").alias("n"))


BLOCKS = pa.list_(pa.struct([("path", pa.string()), ("kind", pa.int32()), ("h", pa.int64()), ("n", pa.int64())]))


def _bodies(bodies: dict) -> pa.RecordBatch:
    host, body = zip(*bodies)
    whole, found = zip(*bodies.values())
    return pa.RecordBatch.from_arrays([pa.array(host), pa.array(body, pa.binary()), pa.array(whole, pa.binary()), pa.array(found, BLOCKS)],
                                      names=["host", "body", "whole", "blocks"])


def _prefixes(path: str) -> Column:
    """The path and every branch above it."""
    return F.expr(f"transform(sequence(2, size(split({path}, '/'))), i -> array_join(slice(split({path}, '/'), 1, i), '/'))")


def importance(counts: DataFrame) -> DataFrame:
    """(host, branch, importance): the highest importance among a branch's nodes."""
    # the effective number of kinds, m * exp(-sum(n log n) / m), over m
    paths = counts.groupBy("host", "path", "kind").agg(F.sum("n").alias("m"), F.count(F.lit(1)).alias("l"),
                                                       F.exp(-F.sum(F.col("n") * F.log("n")) / F.sum("n")).alias("own"))
    # texts count for every branch above them, layouts for their own element
    above = F.explode(F.when(F.col("kind") == TEXT, _prefixes("path")).otherwise(F.array("path"))).alias("path")
    text, g = F.col("kind") == TEXT, F.pow(F.lit(GAMMA), F.col("l"))
    nodes = (paths.where("path <> ''").select("host", "kind", "m", "l", "own", above).groupBy("host", "path")
             .agg((F.sum(F.when(text, F.col("m") * F.col("own"))) / F.sum(F.when(text, F.col("m")))).alias("content"),
                  F.max(F.when(~text, F.col("own"))).alias("shown"), F.max(F.when(~text, g)).alias("g"))
             .where("content IS NOT NULL")
             .select("host", "path", F.coalesce((1 - F.col("g")) * F.col("shown") + F.col("g") * F.col("content"), F.col("content")).alias("importance")))
    return (nodes.select("host", "importance", F.explode(_prefixes("path")).alias("branch")).groupBy("host", "branch")
            .agg(F.round(F.max("importance"), 9).alias("importance")))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", limit: float = LIMIT,
              lists: bool = True) -> DataFrame:
    """Per page: id, url, text, n_chars, by_tree (blocks that the style tree removes) and by_lists (those that only tags or
    classes remove). Without lists the tree decides alone."""
    spark = pages.sparkSession
    ship(spark)
    src = pick(pages, id=id_col, url=url_col, html=html_col)
    tree = importance(style_counts(src, lists))
    poor = (tree.where(F.col("importance") < limit).where(~F.col("branch").rlike("/(html|body|article|main)([.][^/]*)?$"))
            .where(~F.col("branch").rlike(BARE))
            .where(~F.col("branch").rlike("/(article|main)([.][^/]*)?/")))  # branches in there are never removed
    low = (poor.groupBy("host").agg(F.sort_array(F.collect_set("branch")).alias("low"))  # as many as the host's templates have paths
           .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))))
    low = materialize(low, "style")
    host = F.lower(F.coalesce(F.regexp_extract("url", r"(?i)^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]+)", 1), F.lit("")))
    salted = src.withColumn("host", host).withColumn("salt", F.pmod(F.xxhash64("id", "url"), F.lit(SALT)).cast("int"))
    joined = salted.join(low, ["host", "salt"], "left").select("id", "url", "html", "low")

    def run(batches):
        for batch in slices(batches):
            found = [extract(page or "", frozenset(gone or ()), lists) for page, gone in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            texts, by_tree, by_lists = zip(*found) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(by_tree, pa.int64()),
                                              pa.array(by_lists, pa.int64())], names=["id", "url", "text", "by_tree", "by_lists"])

    kind = src.schema["id"].dataType.simpleString()
    return joined.mapInArrow(run, f"id {kind}, url string, text string, by_tree long, by_lists long").select(
        F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"), "by_tree", "by_lists")


def extract(page: str, low: frozenset, lists: bool = True) -> tuple[str, int, int]:
    """(text, blocks removed by the tree, blocks removed by tags and classes alone) of one page; low: the host's template branches."""
    every = blocks(page)
    kept = [b for b in every if b[1] or not _below(b[0], low)]
    if not any(not (lists and b[2]) for b in kept):  # template alone
        kept = every
    by_tree = len(every) - len(kept)
    if lists:
        kept = [b for b in kept if not b[2]]
        if any(b[1] for b in kept):
            kept = [b for b in kept if b[1]]
    return " ".join(b[3] for b in kept), by_tree, len(every) - by_tree - len(kept)


def _below(path: str, low: frozenset) -> bool:
    """Whether the path or a branch above it is in low."""
    if not low:
        return False
    at = len(path)
    while at > 0:
        if path[:at] in low:
            return True
        at = path.rfind("/", 0, at)
    return False

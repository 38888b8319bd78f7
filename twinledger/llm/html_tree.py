"""Main text of web pages by a site style tree.

The element trees of all pages of a host are merged: elements with the same chain of tags, classes and ids are one node. A node is
important if its presentation (the sequence of its children) or its content (words, link and image targets of it and all below
it) differs between pages; both are measured by entropy. Branches of low importance are cut out of every page. What differs on
every page without being the article, such as comments of readers, no entropy can tell: of what the tree leaves, elements that
HTML or their names mark as no article are cut too. Statistics are aggregates over (host, node, feature) that tasks combine
beforehand; no host's pages are brought together. Copies of a page on its host count once, so they don't make its text look
like that of a template.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinledger.llm.common import as_large_text, stored

# A node is cut if its importance, from 0 to 1, is below LOW and it was seen on so many distinct pages of the host.
LOW = 0.3
MIN_PAGES = 10
# Weight of the content of a node with one presentation; with l of them it is to the power of l.
GAMMA = 0.9
# Elements nested deeper than this are part of the node at this level.
DEPTH = 64

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
# Elements that are no article.
NOISE_TAGS = frozenset("head title script style noscript template nav header footer aside form iframe object svg canvas button select textarea option datalist dialog menu audio video map".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NOISE_WORDS = frozenset((
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices notification popup modal overlay "
    "newsletter subscribe subscription sidebar menu nav navbar navigation breadcrumb breadcrumbs masthead footer comment comments disqus respond replies related share sharing "
    "social widget widgets pagination pager login signup search toolbar skip").split())
# Words that go with the above in the name of a role: a name of other words too, like share-price or has-comments, is no such role.
ROLE_WORDS = frozenset((
    "js site main top bottom left right primary secondary global sticky fixed inline list bar box block area container wrapper wrap inner section panel group button buttons btn "
    "link links icon icons item items media post posts article articles form field thread message alert unit slot heading header").split())
# Elements that begin and end a block of text.
BLOCKS = frozenset((
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol p pre search section summary table tbody td tfoot th thead tr ul caption option head title").split())
ARTICLES = frozenset(("article", "main"))
# Elements that the start of another one ends, and what they are looked for in.
ENDS = {"li": ("li", frozenset(("ul", "ol", "menu"))), "dt": ("dt dd", frozenset(("dl",))), "dd": ("dt dd", frozenset(("dl",))), "tr": ("tr td th", frozenset(("table",))),
        "td": ("td th", frozenset(("tr", "table"))), "th": ("td th", frozenset(("tr", "table"))), "option": ("option", frozenset(("select", "datalist")))}
P_SCOPE = frozenset("html body article main section div td th table li ul ol dl dd dt blockquote nav aside header footer form figure fieldset details".split())
# Text elements and wrappers that are never judged by their content alone.
PLAIN = frozenset("body article main p h1 h2 h3 h4 h5 h6 blockquote pre li td th tr tbody thead tfoot dt dd".split())
WORD_EDGE = re.compile(r"[^a-z0-9]+|(?<=[a-z])(?=\d)")
DIGITS = re.compile(r"\d+")
SPACE = re.compile(r"\s+")
UNFINISHED = re.compile(r"</?[A-Za-z]|<[!?]")
HOST = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#]*@)?(\[[^\]/?#]*\]|[^/?#:]*)"


def named_noise(names: str) -> bool:
    """Whether one of the names (classes and ids in lower case) is as a whole that of a role that is no article."""
    for name in names.split():
        parts = [word for word in WORD_EDGE.split(name) if word and not word.isdigit()]
        if not NOISE_WORDS.isdisjoint(parts) and all(word in NOISE_WORDS or word in ROLE_WORDS for word in parts):
            return True
    return False


class Page(HTMLParser):
    """Elements of a page, parents before children, and its blocks of text in page order."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.parent, self.tag, self.path, self.noise, self.named, self.judged, self.hard, self.muted, self.children = [-1], ["#"], [0], [False], [False], [False], [False], [False], [[]]
        self.stack, self.blocks, self.words, self.targets = [0], [], [], []
        self.feed(html)
        # A page that ends within a tag or comment has no more text.
        if UNFINISHED.match(self.rawdata):
            self.rawdata = ""
        self.close()
        self.flush()

    def flush(self) -> None:
        if self.words:
            text = SPACE.sub(" ", "".join(self.words)).strip()
            if text:
                self.blocks.append((self.owner, text))
            self.words = []

    def handle_data(self, data: str) -> None:
        if self.muted[self.stack[-1]]:
            return
        if not self.words:
            # Whatever begins or ends a block ends the text before it, so all words have one innermost block element.
            self.owner = next(n for n in reversed(self.stack) if self.tag[n] in BLOCKS or n == 0)
        self.words.append(data)

    def _pop_to(self, depth: int) -> None:
        if any(self.tag[n] in BLOCKS for n in self.stack[depth:]):
            self.flush()
        del self.stack[depth:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self.words and self.words.append(" ")
            return
        if tag in BLOCKS:
            self.flush()
            for depth in range(len(self.stack) - 1, 0, -1):
                name = self.tag[self.stack[depth]]
                if name == "p":
                    self._pop_to(depth)
                    break
                if name in P_SCOPE:
                    break
        if tag in ENDS:
            ended, within = ENDS[tag]
            cut = 0
            for depth in range(len(self.stack) - 1, 0, -1):
                name = self.tag[self.stack[depth]]
                if name in within:
                    break
                if name in ended.split():
                    cut = depth
            if cut:
                self._pop_to(cut)
        given = dict(attrs)
        target = given.get("href") if tag == "a" else given.get("src") if tag == "img" else None
        if target and not self.muted[self.stack[-1]]:
            self.targets.append((next(n for n in reversed(self.stack) if self.tag[n] in BLOCKS or n == 0), target))
        if tag in VOID:
            return
        up = self.stack[-1]
        names = f"{given.get('class') or ''} {given.get('id') or ''}".lower()
        label = f"{tag} {DIGITS.sub('0', names)}" if names != " " else tag
        self.children[up].append(tag)
        self.parent.append(up)
        self.tag.append(tag)
        self.path.append(xxhash.xxh64_intdigest(label, self.path[up] & 0xFFFFFFFF) & 0x7FFFFFFFFFFFFFFF)
        inside = any(self.tag[n] in ARTICLES for n in self.stack)
        noisy = (tag in NOISE_TAGS and not (tag == "header" and inside)) or "hidden" in given or (given.get("aria-hidden") or "").lower() == "true"
        noisy = noisy or (given.get("role") or "").lower() in NOISE_ROLES
        named = not noisy and names != " " and tag != "html" and tag not in PLAIN and named_noise(names)
        self.noise.append(noisy)
        self.named.append(named)
        # Inline elements that are no article are left out of the text around them; they don't divide it. A name mutes no article within.
        self.hard.append(self.hard[up] or (noisy and tag not in BLOCKS))
        self.muted.append(self.hard[-1] or (tag not in ARTICLES and (self.muted[up] or (named and tag not in BLOCKS))))
        self.judged.append(tag in BLOCKS and (tag not in PLAIN or (names != " " and tag not in ("article", "main"))))
        self.children.append([])
        self.stack.append(len(self.tag) - 1)

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # HTML knows no empty element but the void ones: the slash is ignored.
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.stack) - 1, 0, -1):
            if self.tag[self.stack[depth]] == tag:
                self._pop_to(depth)
                return

    def nodes(self) -> list[int]:
        """What the style tree counts of this page: for each node with text in or below a judged one its path, the hash of its children's
        tags, the number of judged nodes it lies in (itself included) and their paths, the number of its own features and their hashes.
        """
        count = len(self.tag)
        holds, level, site, over = [False] * count, [0] * count, [0] * count, [()] * count
        for node in range(count - 1, 0, -1):
            if self.tag[node] in ARTICLES or holds[node]:
                holds[self.parent[node]] = True
        for node in range(1, count):
            up = self.parent[node]
            level[node] = level[up] + 1
            site[node] = node if level[node] <= DEPTH else site[up]
            over[node] = (*over[up], self.path[node]) if level[node] <= DEPTH and self.judged[node] and not holds[node] else over[up]
        features: dict[int, set[int]] = {}
        for owner, text in self.blocks:
            if over[owner]:
                features.setdefault(site[owner], set()).update(xxhash.xxh64_intdigest(word) >> 1 for word in text.split(" "))
        for owner, target in self.targets:
            if site[owner] in features:
                features[site[owner]].add(xxhash.xxh64_intdigest(target, 1) >> 1)
        met = set(features)
        for node in features:
            # Nodes above were met already where one of them was.
            node = self.parent[node]
            while over[node] and node not in met:
                met.add(node)
                node = self.parent[node]
        out: list[int] = []
        for node in met:
            own = features.get(node, ())
            out += (self.path[node], xxhash.xxh64_intdigest(" ".join(self.children[node])) >> 1, len(over[node]), *over[node], len(own), *own)
        return out

    def main_text(self, cut: frozenset[int] | set[int]) -> str:
        """Blocks of the article, or of the whole page if it has none, outside of what is cut.

        A name cuts no element that holds a main. It cuts one that holds articles (comments, say) only if there is one elsewhere.
        """
        count = len(self.tag)
        dropped, inside, holds, holds_main, within = [False] * count, [False] * count, [False] * count, [False] * count, [False] * count
        for node in range(count - 1, 0, -1):
            if self.tag[node] in ARTICLES or holds[node]:
                holds[self.parent[node]] = True
            if self.tag[node] == "main" or holds_main[node]:
                holds_main[self.parent[node]] = True
        elsewhere = False
        for node in range(1, count):
            within[node] = within[self.parent[node]] or self.noise[node] or (self.named[node] and not holds_main[node])
            elsewhere = elsewhere or (self.tag[node] in ARTICLES and not within[node])
        for node in range(1, count):
            up = self.parent[node]
            named = self.named[node] and not holds_main[node] and (elsewhere or not holds[node])
            dropped[node] = dropped[up] or self.noise[node] or named or (self.path[node] in cut and self.judged[node] and not holds[node])
            inside[node] = inside[up] or (self.tag[node] in ARTICLES and not dropped[node])
        whole = not any(inside)
        return "\n".join(text for owner, text in self.blocks if not dropped[owner] and (whole or inside[owner]))


def host_key(url_col: str) -> Column:
    """A hash of the host of a URL in lower case; all URLs without one have the same."""
    return F.xxhash64(F.lower(F.coalesce(F.regexp_extract(F.col(url_col).cast("string"), HOST, 1), F.lit(""))))


COMBINE = 200_000


def _page_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, html) to (host, page, nodes) for pages with judged nodes; page is a hash of the html. Copies a task has met lately
    are left out."""
    met: set[tuple[int, bytes]] = set()
    for batch in batches:
        hosts, pages, nodes = [], [], []
        for host, html in zip(batch.column(0).to_pylist(), as_large_text(batch.column(1)).to_pylist()):
            key = host, xxhash.xxh3_128_digest(html.encode("utf-8", "surrogatepass"))
            if key in met:
                continue
            if len(met) >= COMBINE:
                met.clear()
            met.add(key)
            found = Page(html).nodes()
            if found:
                hosts.append(host)
                pages.append(key[1])
                nodes.append(found)
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.int64()), pa.array(pages, pa.binary()), pa.array(nodes, pa.list_(pa.int64()))], names=["host", "page", "nodes"])


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (host, nodes) to (host, path, kind, value, pages), combined: kind 0 is the node itself, 1 its children, 2 a feature, 3 a
    judged node it lies in."""
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        keys = list(counts)
        batch = pa.RecordBatch.from_arrays([*(pa.array([k[i] for k in keys], pa.int64()) for i in range(4)), pa.array([counts[k] for k in keys], pa.int64())], names=["host", "path", "kind", "value", "pages"])
        counts.clear()
        return batch

    for batch in batches:
        for row in range(len(batch)):
            host, nodes, seen, at = batch.column(0)[row].as_py(), batch.column(1)[row].values.to_pylist(), set(), 0
            while at < len(nodes):
                path, style, n = nodes[at: at + 3]
                end = at + 3 + n
                seen |= {(host, path, 0, 0), (host, path, 1, style)}
                seen.update((host, path, 3, up) for up in nodes[at + 3: end])
                seen.update((host, path, 2, value) for value in nodes[end + 1: end + 1 + nodes[end]])
                at = end + 1 + nodes[end]
            counts.update(seen)
            if len(counts) >= COMBINE:
                yield out()
    if counts:
        yield out()


def style_tree(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Judged nodes of all hosts: host and path (hashes), distinct pages, presentation, content and importance from 0 to 1.

    Pages of a host with the same html are one page. Presentation of a node on m pages with sequences of children that k1, k2, ... of
    them share is 1 - sum(k log k) / (n log m), n being the sum of the k: 0 if all pages share one, 1 if each has its own. Content is the mean of
    1 - log k / log m over all features in or below the node, k being the pages that have the feature in the node whose own it is and m
    those that have this node: 0 if all have the same words and targets. Importance is (1 - g^l) presentation + g^l content, l
    being the number of sequences and g ``GAMMA``. On one page all are 1.
    """
    nodes = pages.select(host_key(url_col).alias("host"), F.col(html_col).cast("string")).mapInArrow(_page_nodes, "host long, page binary, nodes array<long>")
    distinct = nodes.groupBy("host", "page").agg(F.first("nodes").alias("nodes"))
    counts = distinct.select("host", "nodes").mapInArrow(_statistics, "host long, path long, kind long, value long, pages long")
    values = counts.groupBy("host", "path", "kind", "value").agg(F.sum("pages").alias("k"))
    of = lambda kind, what: F.when(F.col("kind") == kind, what)
    log_k = F.log(F.col("k").cast("double"))
    # A node lies in as many judged ones as its path has elements, DEPTH at most.
    node = stored(values.groupBy("host", "path").agg(
        F.sum(of(0, F.col("k"))).alias("m"), F.sum(of(1, F.col("k"))).alias("n"), F.sum(of(1, F.col("k") * log_k)).alias("s"), F.count(of(1, F.lit(1))).alias("l"),
        F.count(of(2, F.lit(1))).alias("features"), F.coalesce(F.sum(of(2, log_k)), F.lit(0.0)).alias("shared"), F.collect_set(of(3, F.col("value"))).alias("over")), "style-nodes")
    log_m = F.log(F.col("m").cast("double"))
    own = F.col("features") - F.when(F.col("m") > 1, F.col("shared") / log_m).otherwise(F.lit(0.0))
    below = node.where("features > 0").select("host", F.explode("over").alias("path"), "features", own.alias("own")).groupBy("host", "path").agg(
        (F.sum("own") / F.sum("features")).alias("content"))
    weight = F.pow(F.lit(GAMMA), F.col("l"))
    several = F.col("m") > 1
    judged = node.join(below, ["host", "path"]).withColumn("presentation", F.when(several, 1 - F.col("s") / (F.col("n") * log_m)).otherwise(F.lit(1.0)))
    return judged.select("host", "path", F.col("m").alias("pages"), "presentation", "content",
                         F.when(several, (1 - weight) * F.col("presentation") + weight * F.col("content")).otherwise(F.lit(1.0)).alias("importance"))


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", low: float = LOW, min_pages: int = MIN_PAGES) -> DataFrame:
    """Per page: its id, url, text (blocks joined by line feeds; empty if there is none), n_chars.

    A NULL page is an empty one. Pages without a readable URL are one host of their own. Rows that repeat an id are pages of their
    own. Other columns are ignored; an empty table gives an empty result. Nodes to cut, which are less important than ``low``, are
    joined by host; their number depends on the templates of a host, not on its pages, since each was seen on ``min_pages``
    distinct pages with hardly any difference.
    """
    unimportant = style_tree(pages, url_col, html_col).where((F.col("pages") >= min_pages) & (F.col("importance") < low))
    cuts = stored(unimportant.groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("_cut")), "style-tree")
    given = pages.select(F.col(id_col).alias("_id"), F.col(url_col).cast("string").alias("_url"), F.col(html_col).cast("string").alias("_html")).withColumn("host", host_key("_url"))
    joined = given.join(cuts, "host", "left").select("_id", "_url", "_html", "_cut")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [Page(html).main_text(set(cut or ())) for html, cut in zip(as_large_text(batch.column(2)).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    from pyspark.sql.types import LongType, StringType, StructType

    schema = StructType().add(id_col, pages.schema[id_col].dataType).add(url_col, StringType()).add("text", StringType()).add("n_chars", LongType())
    return joined.mapInArrow(extract, schema)

"""Main text of web pages, with a suffix array for each host (operator 5).

A page is cut into blocks. Blocks inside menus, headers, footers, sidebars, notices,
adverts, forms and comments go by their markup. Where a page marks its article, the
blocks in it are the main text. Where it doesn't, the token streams of the host's pages
are concatenated, token runs that repeat across distinct pages are found by their ranks
in the suffix array and removed, and the unique runs stay.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthlake.llm.byte_bpe import chunks
from hearthlake.llm.common import given, let, stored
from hearthlake.llm.passages import rolled, word_hashes
from hearthlake.llm.url_filter import host_of

#: A run of so many tokens, a power of two, that so many distinct pages have is boilerplate.
RUN_TOKENS, RUN_PAGES = 8, 3
#: Tokens of a run's anchor. Shorter anchors are fewer but repeat more often by chance.
ANCHOR_TOKENS = 4
#: Rows that a task hands on at a time.
BATCH_ROWS = 200_000
#: Keys (8 bytes each) and places (4 bytes) are broadcast up to so many, digests up to a quarter, and joined by a shuffle beyond.
BROADCAST_ROWS = 4_000_000

#: Fixed values of HTML: elements without content, elements that start a new block.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: A start tag ends an open element of these names, as browsers do.
ENDS = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Elements, roles and words of class and id whose content isn't main text.
ASIDE = frozenset(
    "aside audio button canvas datalist dialog footer form head header iframe math menu nav noscript object script select style svg"
    " template textarea title video".split()
)
ASIDE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
ASIDE_WORDS = frozenset(
    "ad ads adbox advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus"
    " footer header menu menubar modal nav navbar navigation newsletter notice notices pagination popup promo related replies reply"
    " share sharing sidebar sidebars social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Of these elements an article that stands inside may be the page's; of the other asides none is.
LIFTED = frozenset("form header menu nav".split())
#: Names of what readers wrote or what is offered beside, unless the name only says that an element has it.
BESIDE = frozenset("comment comments disqus related replies reply".split())
HAVING = frozenset("has no with without".split())
_WORDS = re.compile(r"[A-Za-z]+")
#: Class names such as sideBar and adUnit hold their words by capitals.
_CAPITAL = re.compile(r"(?<=[a-z])(?=[A-Z])")


class _Blocks(HTMLParser):
    """Collects a page's blocks: (text, inside the article).

    With ``lift`` an article or main element counts though elements around it are set
    aside, by their names, roles or as one of ``LIFTED``.
    """

    def __init__(self, lift: bool = False):
        super().__init__(convert_charrefs=True)
        self.lift = lift
        self.open: list[tuple[str, int, bool, bool]] = []  # name, what it adds to asides, article, firm aside
        self.names: Counter[str] = Counter()
        self.asides = self.articles = 0
        self.firm = 0  # asides that nothing inside lifts
        self.pieces: list[str] = []
        self.blocks: list[tuple[str, bool]] = []

    def end_block(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            self.pieces = []
            if text:
                self.blocks.append((text, self.articles > 0))

    def pop(self) -> None:
        name, aside, article, firm = self.open.pop()
        self.names[name] -= 1
        if name in BLOCK or aside:
            self.end_block()
        self.asides -= aside
        self.articles -= article
        self.firm -= firm

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        for name in ENDS.get(tag, ()):
            # Only up to the nearest element that holds others of its kind, and only if one is open.
            for depth in range(len(self.open) - 1, -1, -1) if self.names[name] else ():
                inner = self.open[depth][0]
                if inner == name:
                    while len(self.open) > depth:
                        self.pop()
                    break
                if inner in BLOCK and inner != "p":
                    break
        if tag in BLOCK:
            self.end_block()
        if tag == "br":
            self.pieces.append(" ")
        if tag in VOID:
            return
        given_ = {k: v or "" for k, v in attrs}
        role = given_.get("role", "").lower()
        unseen = "hidden" in given_ or given_.get("aria-hidden") == "true"
        firm = unseen or tag in ASIDE - LIFTED
        aside = tag in ASIDE or role in ASIDE_ROLES or unseen
        if not aside and tag not in ("html", "body", "article", "main"):
            named = _CAPITAL.sub(" ", given_.get("class", "") + " " + given_.get("id", ""))
            aside = any(w.lower() in ASIDE_WORDS for w in _WORDS.findall(named))
            names = [[w.lower() for w in _WORDS.findall(name)] for name in named.split()] if aside else []
            firm = any(words[0] not in HAVING and not BESIDE.isdisjoint(words) for words in names if words)
        elif tag == "article" and not aside:
            # Comments are often articles themselves.
            aside = any(w.lower() in ("comment", "comments", "reply", "replies") for w in _WORDS.findall(given_.get("class", "")))
            firm = aside
        if aside:
            self.end_block()
        article = tag in ("article", "main") or role in ("main", "article")
        adds = int(aside)
        if self.lift and article and not aside and not self.firm and self.asides:
            self.end_block()
            adds = -self.asides
        self.open.append((tag, adds, article, firm))
        self.names[tag] += 1
        self.asides += adds
        self.articles += article
        self.firm += firm

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # browsers ignore the slash

    def handle_endtag(self, tag: str) -> None:
        for depth in range(len(self.open) - 1, -1, -1) if self.names[tag] else ():
            if self.open[depth][0] == tag:
                while len(self.open) > depth:
                    self.pop()
                return
        if tag in BLOCK:
            self.end_block()

    def handle_data(self, data: str) -> None:
        if not self.asides:
            self.pieces.append(data)


def _blocks_of(html: str, lift: bool) -> list[tuple[str, bool]]:
    parser = _Blocks(lift)
    parser.feed(html)
    parser.close()
    while parser.open:
        parser.pop()
    parser.end_block()
    return parser.blocks


def blocks_of(html: str | None) -> list[tuple[str, bool]]:
    """The blocks of a page in order, without what its markup sets aside: (text, inside the article).

    Where no article is left, since an element around it is named like a sidebar, is a
    form or a menu that was never closed, the articles inside such elements count, if
    they have more text than what is left without them.
    """
    found = _blocks_of(html or "", False)
    if any(inside for _, inside in found):
        return found
    lifted = _blocks_of(html or "", True)
    size = lambda blocks: sum(len(text) for text, _ in blocks)
    return lifted if size(b for b in lifted if b[1]) > size(found) else found


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each run of RUN_TOKENS tokens the hash and the place of its anchor: of its runs of ANCHOR_TOKENS tokens the one with the smallest hash.

    The anchor depends on the run's tokens only, so runs that are equal have equal anchors.
    """
    short = rolled(hashes, ANCHOR_TOKENS)
    width = RUN_TOKENS - ANCHOR_TOKENS + 1
    if len(short) < width:
        return np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)
    place = np.lib.stride_tricks.sliding_window_view(short, width).argmin(axis=1)
    place = place + np.arange(len(place))
    return short[place], place


def _host_keys(hashes: np.ndarray, host: str) -> np.ndarray:
    return (hashes ^ np.uint64(xxhash.xxh64_intdigest(host))).view(np.int64)


def anchor_pages(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's different anchors: the key of host and anchor, and 32 bits of the page's digest."""
    keys, pages, size = [], [], 0

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(pages))], names=["key", "page"])

    for batch in found:
        for page, host, tokens in zip(*[c.to_pylist() for c in batch.columns]):
            own = _host_keys(np.unique(anchors(word_hashes(tokens.split(" ")))[0]), host)
            keys.append(own)
            pages.append(np.full(len(own), int.from_bytes(page[:4], "little", signed=True), dtype=np.int32))
            size += len(own)
            if size > BATCH_ROWS:
                yield batch_of()
                keys, pages, size = [], [], 0
    if size:
        yield batch_of()


def anchor_spans(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each page with runs: page, host, and of each stretch of neighbouring runs with one anchor the key, the first run's place and the tokens."""
    pages, hosts, ends, keys, places, texts = [], [], [0], [], [], []

    def batch_of() -> pa.RecordBatch:
        spans = [pa.array(np.concatenate(keys)), pa.array(np.concatenate(places).astype(np.int32)), pa.array(texts, pa.string())]
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(spans, names=["key", "start", "tokens"]))
        return pa.RecordBatch.from_arrays([pa.array(pages, pa.binary()), pa.array(hosts, pa.string()), lists], names=["page", "host", "spans"])

    for batch in found:
        for page, host, text in zip(*[c.to_pylist() for c in batch.columns]):
            tokens = text.split(" ")
            hashes, place = anchors(word_hashes(tokens))
            if not len(place):
                continue
            starts = np.concatenate([[0], np.flatnonzero(np.diff(place)) + 1])
            keys.append(_host_keys(hashes[starts], host))
            places.append(starts)
            texts += [" ".join(tokens[x : y + RUN_TOKENS - 1]) for x, y in zip(starts.tolist(), [*starts[1:].tolist(), len(place)])]
            pages.append(page)
            hosts.append(host)
            ends.append(len(texts))
            if len(texts) > BATCH_ROWS:
                yield batch_of()
                pages, hosts, ends, keys, places, texts = [], [], [0], [], [], []
    if pages:
        yield batch_of()


def _small(frame: DataFrame, rows: int) -> DataFrame:
    """The frame broadcast where it counts up to BROADCAST_ROWS, and joined by a shuffle beyond."""
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def repeated_places(rows: DataFrame) -> DataFrame:
    """_page and _places, where a run of the page's tokens starts that RUN_PAGES distinct pages of its host have.

    ``rows`` has _page, _host and _tokens. Suffixes of all streams of a host that agree in
    their first RUN_TOKENS tokens are one rank, and a rank's distinct pages are counted
    over the whole host. So that not every suffix is shuffled, anchors are counted first:
    of a run on RUN_PAGES pages, the anchor is on as many, so no run is lost, and keys
    that copies of one page hold alone go. Then the runs of the anchors that are left are
    counted, known by a 128-bit digest of host and tokens. Distinct pages come before the
    count, so a run on all pages is one row for each task.
    """
    streams = rows.select("_page", "_host", "_tokens")
    counted = streams.mapInArrow(anchor_pages, "key long, page int").groupBy("key")
    counted = counted.agg(F.count(F.lit(1)).alias("n"), F.min("page").alias("least"), F.max("page").alias("most"))
    shared = stored(counted.where((F.col("n") >= RUN_PAGES) & (F.col("least") < F.col("most"))).select("key"))
    spans = streams.mapInArrow(anchor_spans, "page binary, host string, spans array<struct<key: long, start: int, tokens: string>>")
    spans = stored(spans.select("page", "host", F.inline("spans")).join(_small(shared, shared.count()), "key").drop("key"))
    each = let(F.split("tokens", " "), lambda t: F.transform(F.sequence(F.lit(1), F.size(t) - RUN_TOKENS + 1), lambda i: F.array_join(F.slice(t, i, RUN_TOKENS), " ")))
    runs = spans.select("page", "host", "start", F.posexplode(each).alias("_at", "_run"))
    runs = runs.withColumn("run", F.unhex(F.md5(F.concat("host", F.lit("/"), "_run")))).drop("host", "_run")
    repeated = runs.select("run", "page").distinct().groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    # Stored, so that the join deals both sides anew and a hot run may be split.
    repeated = stored(repeated.where(F.col("n") >= RUN_PAGES).select("run"))
    places = runs.join(_small(repeated, 4 * repeated.count()), "run").select(F.col("page").alias("_page"), (F.col("start") + F.col("_at")).alias("_place"))
    found = stored(places.groupBy("_page").agg(F.collect_set("_place").alias("_places")))
    return _small(found, found.agg(F.coalesce(F.sum(F.size("_places")), F.lit(0))).first()[0])


def main_text(texts: list[str], inside: list[bool], places: list[int]) -> tuple[str, int]:
    """The main text of a page's blocks, and how many of its tokens lie in runs that start at ``places``."""
    covered = np.zeros(sum(text.count(" ") + 1 for text in texts), dtype=bool)
    for place in places:
        covered[place : place + RUN_TOKENS] = True
    if any(inside):
        kept = [text for text, own in zip(texts, inside) if own]
    else:
        kept, at = [], 0
        for text in texts:
            tokens = text.split(" ")
            unique = [t for t, c in zip(tokens, covered[at : at + len(tokens)]) if not c]
            at += len(tokens)
            if unique:
                kept.append(" ".join(unique))
    return "\n\n".join(kept), int(covered.sum())


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, url, _host, and the blocks as _texts and _inside, one row for each row of ``pages`` (page_id, url, html)."""
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("_host"), "html")
    kind = rows.schema["page_id"].dataType.simpleString()

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            for part in chunks(batch, 3):
                blocks = [blocks_of(html) for html in part.column(3).to_pylist()]
                texts = pa.array([[t for t, _ in own] for own in blocks], pa.list_(pa.string()))
                inside = pa.array([[i for _, i in own] for own in blocks], pa.list_(pa.bool_()))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], texts, inside], names=["page_id", "url", "_host", "_texts", "_inside"])

    return rows.mapInArrow(batches, f"page_id {kind}, url string, _host string, _texts array<string>, _inside array<boolean>")


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars and repeated_tokens, one row for each row of ``pages`` (page_id, url, html).

    NULL html counts as empty; a page without main text has an empty text. Token runs are
    counted over all pages of a host, however many, so the result doesn't depend on
    partitions or other hosts. Only the texts of pages that mark no article depend on
    them. A NULL url has the empty host. Pages of one host with the same tokens are one
    page to the counts, known by a digest of both, so copies of a page aren't each other's
    boilerplate. An empty table gives an empty result. Pages are parsed once and their
    blocks stored in the shared folder.
    """
    tokens = F.array_join("_texts", " ")
    rows = stored(parsed(pages), "zstd").withColumn("_page", F.unhex(F.md5(F.concat("_host", F.lit("/"), tokens))))  # a host has no slash
    kind = rows.schema["page_id"].dataType.simpleString()

    def batches(found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in found:
            texts = [main_text(t, i, p or []) for t, i, p in zip(*[c.to_pylist() for c in batch.columns[2:]])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([t for t, _ in texts], pa.string()),
                    pa.array([len(t) for t, _ in texts], pa.int64()),
                    pa.array([n for _, n in texts], pa.int64()),
                ],
                names=["page_id", "url", "text", "n_chars", "repeated_tokens"],
            )

    places = repeated_places(rows.select("_page", "_host", tokens.alias("_tokens")))
    found = rows.join(places, "_page", "left").select("page_id", "url", "_texts", "_inside", "_places")
    return found.mapInArrow(batches, f"page_id {kind}, url string, text string, n_chars long, repeated_tokens long")


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(given(spark, sf_dir, "pages"))

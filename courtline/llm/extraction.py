"""Main texts of web pages by templates deduced from equivalence classes of tokens.

A page's tokens are its elements, by their path of names, classes and ids, and
the texts of its blocks. Over the pages of one host, a token's occurrence
vector says how often each page has it. Tokens of one vector are an
equivalence class; a class that is frequent and large enough, and whose tokens
stand in one order under each parent on every page, is valid. Paths nest the
valid classes into the host's template. What a page has beyond the template's
own texts are its slots: the region that the main texts of a host's pages
fill is looked for in the template, and its slots are extracted.

A vector is never written out: the sums of two hashes of (page, count) over
the pages, with the numbers of pages and occurrences, stand for it, so tasks
add up their pages and no host has to be in one place. A page whose host has no
template (a single page, no url, or nothing in common) or that lacks its
region is its own template.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtline.llm import common

# --- fixed values of HTML ----------------------------------------------------

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Contents that are no markup, up to the end tag.
RAW = frozenset("iframe noembed noframes noscript script style textarea title xmp".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark meter output progress q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
CONTAINER = frozenset("article body center div html main section table tbody td tr".split())
#: A start tag of the first kind ends an open element of the second kinds.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "body": ("head",)}
#: Where the search for such an element stops.
BOUNDS = frozenset("article aside body div footer header html main nav section table ul ol dl td th".split())
NOISE_TAGS = frozenset("aside audio button canvas datalist dialog fieldset footer form head iframe map menu nav object select svg template video".split())
#: Words of classes, ids and roles that name what is no part of an article.
COMMENT_WORDS = frozenset("comment comments commentlist discussion disqus reply replies respond responses".split())
NOISE_WORDS = COMMENT_WORDS | frozenset(
    "ad ads advert advertisement advertisements advertising adverts adsense aside banner banners breadcrumb breadcrumbs complementary consent contentinfo "
    "cookie cookies dialog disclaimer footer gdpr hidden login masthead menu menus modal nav navbar navigation newsletter notice notices "
    "overlay pager pagination paywall popup promo promos promotion promotions recommended related search share sharing sidebar sidebars signup "
    "social sponsor sponsored sponsors subscribe subscription teaser teasers toolbar topbar tracking trending widget widgets".split()
)
#: A word after one of these says what a layout has, not what it is.
HAS = frozenset(("has", "with", "no", "without", "hide", "show"))

_ATTRIBUTES = r"""(?>[^>"'=]+|=\s*+"[^"]*"|=\s*+'[^']*'|["'=])*+"""
_TOKEN = re.compile(rf"([^<]+)|<!--(?:.*?--!?>|.*)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)({_ATTRIBUTES})>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|(</?[a-zA-Z].*)|(<)", re.DOTALL)
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.IGNORECASE) for t in RAW}

#: Kinds of tokens.
IN_REGION, ARTICLE, MAIN, TEXT = 1, 2, 4, 8
_ROOT = 0
_NO, _SOFT, _HARD = 0, 1, 2


def _hashed(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


class _Tags(dict):
    """What a start tag says by itself: (segment of its path, noise, article or main), by name and attributes."""

    LIMIT = 20_000

    def __missing__(self, tag: tuple[str, str]) -> tuple[str, int, int]:
        name, attributes = tag
        found = {k.lower(): a or b or c for k, a, b, c in _ATTRIBUTE.findall(attributes)}
        names = f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}"
        noise = _HARD if name in NOISE_TAGS else _NO
        kind = ARTICLE if name == "article" or found.get("itemprop", "").lower() == "articlebody" else MAIN if name == "main" or found.get("role") == "main" else 0
        if name not in ("html", "body", "main") and names.strip():
            for one in names.split():
                words = [w.lower() for w in _WORD.findall(one)]
                told = {w for i, w in enumerate(words) if not i or words[i - 1] not in HAS}
                if told & COMMENT_WORDS:
                    noise = _HARD
                elif told & NOISE_WORDS:
                    noise = max(noise, _SOFT)
        classes = ".".join(sorted(found.get("class", "").split()))
        segment = re.sub("[0-9]+", "0", f"{name}.{classes}#{found.get('id', '')}") if classes or "id" in found else name
        if len(self) >= self.LIMIT:
            self.clear()
        self[tag] = segment, noise, kind
        return self[tag]


class _Paths(dict):
    """The hash of a path, by its parent's hash and its last segment."""

    LIMIT = 200_000

    def __missing__(self, at: tuple[int, str]) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        self[at] = out = _hashed(f"{at[0]}/{at[1]}")
        return out


_tags, _paths = _Tags(), _Paths()


class Page:
    """A page's elements in the order of their start tags, and its blocks of text.

    elements: [path, parent element, noise, kind, weight]; the weight is the
    text outside of links that an element's blocks hold themselves.
    blocks: (element, text, weight, whether a main heading), without noise.
    inline: counts of inline elements' paths.
    """

    def __init__(self, html: str):
        self.elements: list[list] = [[_ROOT, -1, _NO, 0, 0]]
        self.blocks: list[tuple[int, str, int, bool]] = []
        self.inline: dict[int, list[int]] = {}
        self._read(html)

    def _read(self, html: str) -> None:
        elements = self.elements
        stack: list[tuple[int, str]] = [(0, "")]
        count: dict[str, int] = {}
        inline: list[tuple[str, int, int]] = []  # name, noise, height of the stack
        text: list[str] = []
        weight = 0

        def flush() -> None:
            nonlocal weight
            if text:
                said = " ".join(entities.unescape("".join(text)).split())
                if said:
                    at, name = stack[-1]
                    weight = min(weight, len(said))
                    elements[at][4] += weight
                    self.blocks.append((at, said, weight, name == "h1"))
                text.clear()
            weight = 0

        def pop_to(height: int) -> None:
            while len(stack) > height:
                count[stack.pop()[1]] -= 1
            while inline and inline[-1][2] > height:
                inline.pop()

        def end_open(names: Iterable[str], bounds: frozenset) -> None:
            if any(count.get(n) for n in names):
                for height in range(len(stack) - 1, 0, -1):
                    if stack[height][1] in names:
                        return pop_to(height)
                    if stack[height][1] in bounds:
                        return None
            return None

        at, size = 0, len(html)
        while at < size:
            m = _TOKEN.match(html, at)
            at = m.end()
            kind = m.lastindex
            if kind == 1 or kind == 9:  # text, or a lone <
                if not elements[stack[-1][0]][2] and not any(x[1] for x in inline):
                    text.append(m[0])
                    if not any(x[0] == "a" for x in inline):
                        weight += len(m[0])
                continue
            if kind == 8:  # a tag that never ends
                break
            if not kind:  # comment or declaration
                continue
            closing, name, attributes = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
            name = name.lower()
            if closing:
                if name in INLINE:
                    for i in range(len(inline) - 1, -1, -1):
                        if inline[i][0] == name:
                            del inline[i]
                            break
                elif count.get(name):
                    flush()
                    for height in range(len(stack) - 1, 0, -1):
                        if stack[height][1] == name:
                            pop_to(height)
                            break
                else:
                    flush()
                continue
            if name in RAW:
                end = _RAW_END[name].search(html, at)
                at = end.end() if end else size
                if name not in ("textarea", "noscript"):
                    continue
            segment, noise, kind = _tags[name, attributes if "=" in attributes else ""]
            if name in INLINE:
                path = _paths[elements[stack[-1][0]][0], segment]
                if path in self.inline:
                    self.inline[path][0] += 1
                else:
                    self.inline[path] = [1, len(elements), stack[-1][0]]
                if name in ("br", "wbr", "img"):
                    if name == "br" and text:
                        text.append(" ")
                elif not attributes.endswith("/"):
                    inline.append((name, noise, len(stack)))
                continue
            flush()
            if name in ENDS:
                end_open(ENDS[name], BOUNDS - frozenset(ENDS[name]))
            if count.get("p"):
                end_open(("p",), BOUNDS)
            over = stack[-1][0]
            inside = elements[over]
            in_article = inside[3] & ARTICLE
            if name == "header" and not noise and not in_article and not inside[3] & MAIN:
                noise = _SOFT
            if inside[2] and not (inside[2] == _SOFT and kind and not noise):
                noise = max(noise, inside[2])
            kind = 0 if noise else kind | (inside[3] & (ARTICLE | MAIN))
            elements.append([_paths[inside[0], segment], over, noise, kind | (IN_REGION if name in CONTAINER else 0), 0])
            if name not in VOID and name not in RAW:
                stack.append((len(elements) - 1, name))
                count[name] = count.get(name, 0) + 1
        flush()

    def weights(self) -> list[int]:
        """Each element's text outside of links, with that of the elements in it."""
        total = [e[4] for e in self.elements]
        for i in range(len(total) - 1, 0, -1):
            total[self.elements[i][1]] += total[i]
        return total

    def tokens(self) -> list[tuple[int, int, int, int, int]]:
        """(token, parent, occurrences, weight, kind), elements in the order of their first start tags.

        Texts are tokens where no article holds them: an article's own
        sentences are never a template's.
        """
        out: dict[int, list[int]] = {}
        total = self.weights()
        for i, (path, parent, _, kind, _) in enumerate(self.elements):
            over = self.elements[parent]
            top = kind & ARTICLE and not over[3] & ARTICLE, kind & MAIN and not over[3] & MAIN
            kind = kind & IN_REGION | (ARTICLE if top[0] else 0) | (MAIN if top[1] else 0)
            if path in out:
                out[path][1] += 1
                out[path][2] += total[i]
            elif i:
                out[path] = [over[0], 1, total[i], kind]
        for path, (n, _, parent) in self.inline.items():
            out.setdefault(path, [self.elements[parent][0], n, 0, 0])
        for at, said, weight, _ in self.blocks:
            element = self.elements[at]
            if not element[3] & ARTICLE:
                t = text_token(element[0], said)
                if t in out:
                    out[t][1] += 1
                    out[t][2] += weight
                else:
                    out[t] = [element[0], 1, weight, TEXT]
        return [(t, *v) for t, v in out.items()]

    def chosen(self, region: Iterable[int], template_texts: frozenset = frozenset()) -> list[str]:
        """The blocks within ``region``'s paths that aren't the template's, after the main heading where that stands outside."""
        region = frozenset(region)
        inside = [False] * len(self.elements)
        for i, (path, parent, noise, _, _) in enumerate(self.elements):
            inside[i] = not noise and (path in region or (parent >= 0 and inside[parent]))
        out, headed, before = [], False, []
        for at, said, _, heading in self.blocks:
            if inside[at]:
                if text_token(self.elements[at][0], said) not in template_texts or self.elements[at][3] & ARTICLE:
                    headed = headed or heading
                    out.append(said)
            elif heading and not out:
                before.append(said)
        return out if headed or not out else before + out


def text_token(path: int, said: str) -> int:
    return _hashed(f"{path}\t{said}")


def region_of(tokens: Iterable[tuple[int, int, int, int]]) -> list[int]:
    """The paths that hold the main text, from (token, parent, weight, kind) of a template or of one page.

    The outermost articles, where they hold a fifth of the text or more (not
    those with under a tenth of the largest one's). Else from the main element,
    or the page, down as long as one container holds three fifths of the text.
    """
    elements = {t: (parent, weight, kind) for t, parent, weight, kind in tokens if not kind & TEXT}
    texts = sum(w for _, _, w, k in tokens if k & TEXT)
    total = max(sum(w for p, w, _ in elements.values() if p not in elements), texts)
    if not total:
        return []
    articles = {t: w for t, (_, w, k) in elements.items() if k & ARTICLE and w}
    if 5 * sum(articles.values()) >= total:
        return sorted(t for t, w in articles.items() if 10 * w >= max(articles.values()))
    below: dict[int, list[tuple[int, int]]] = {}
    for t, (parent, weight, kind) in elements.items():
        if kind & IN_REGION and weight:
            below.setdefault(parent if parent in elements else _ROOT, []).append((weight, t))
    mains = [(w, t) for t, (_, w, k) in elements.items() if k & MAIN and 2 * w >= total]
    weight, at = max(mains, default=(total, _ROOT))
    while at in below and 5 * max(below[at])[0] >= 3 * weight:
        weight, at = max(below[at])
    return [at]


# --- Spark -------------------------------------------------------------------

_TOKENS = "host string, _row long, tokens array<struct<t: long, parent: long, n: long, weight: long, kind: long>>"
_STRUCT = pa.list_(pa.struct([(c, pa.int64()) for c in ("t", "parent", "n", "weight", "kind")]))
#: Bytes of templates that are sent to every task; larger ones are joined by host.
BROADCAST = 32 << 20
#: Parts of a host's pages in that join.
SALTS = 64


def _tokenised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("t", "parent", "n", "weight", "kind")
    for b in common.pieces(batches, 64):
        tokens = [[dict(zip(names, t, strict=True)) for t in Page(x).tokens()] for x in b.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("host"), b.column("_row"), pa.array(tokens, _STRUCT)], names=["host", "_row", "tokens"])


def _by_host(df: DataFrame, per_host: DataFrame, size: int, bound: int) -> DataFrame:
    """Left join on host: ``per_host`` is sent to all tasks where its ``size`` is proven to be under ``bound``; else hosts are split by salts."""
    if size <= bound:
        return df.join(F.broadcast(per_host), "host", "left")
    salted = per_host.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return df.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.lit(SALTS)).cast("int")).join(salted, ["host", "_salt"], "left").drop("_salt")


def classes(tokens: DataFrame, share: float = 0.5, least: int = 3, bound: int = BROADCAST) -> DataFrame:
    """The tokens of each host's valid equivalence classes: host, t, parent, weight, kind, class.

    ``tokens`` has one row for each page (host, _row, tokens). A class is
    frequent on ``share`` of its host's pages and on two at least, so a host's
    template has at most 1 / ``share`` times the tokens of its mean page. It is
    large with ``least`` tags and texts (an element has two tags). Siblings of a
    class that change places between pages are left out, with no harm to the
    rest of it.
    """
    each = tokens.select("host", "_row", F.explode("tokens").alias("x")).select("host", "_row", "x.*")
    mask = F.lit((1 << 31) - 1).cast("long")
    vectors = each.groupBy("host", "t").agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("n").alias("occurrences"),
        *[F.sum(F.xxhash64(F.lit(s), "_row", "n").bitwiseAND(mask)).alias(f"v{s}") for s in (1, 2)],
        F.sum("weight").alias("weight"),
        F.max("parent").alias("parent"),
        F.max("kind").alias("kind"),
    )
    hosts = tokens.groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    frequent = vectors.join(hosts, "host").filter(F.col("pages") >= F.greatest(F.lit(2), F.ceil(F.col("of") * share)))
    vector = F.xxhash64("pages", "occurrences", "v1", "v2")
    frequent = common.stored(frequent.withColumn("class", vector), "vectors")
    large = frequent.groupBy("host", "class").agg(F.sum(F.when(F.col("kind").bitwiseAND(TEXT) > 0, 1).otherwise(2)).alias("_size"))
    frequent = frequent.join(large.filter(F.col("_size") >= least), ["host", "class"], "left_semi").withColumn("siblings", F.xxhash64("class", "parent"))
    frequent = common.stored(frequent.select("host", "t", "parent", "weight", "kind", "class", "siblings"), "classes")
    # each page's order of each group of siblings
    maps = frequent.groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("t", "siblings"))).alias("group_of"))
    size = 64 * frequent.count()
    placed = _by_host(tokens, maps, size, bound).filter("group_of IS NOT NULL").selectExpr(
        "host", "filter(transform(tokens, x -> struct(group_of[x.t] AS g, x.t AS t)), x -> x.g IS NOT NULL) AS placed"
    )
    orders = placed.selectExpr("host", "placed", "explode(array_distinct(placed.g)) AS siblings").selectExpr(
        "host", "siblings", "xxhash64(transform(filter(placed, x -> x.g = siblings), x -> x.t)) AS o"
    )
    valid = orders.groupBy("host", "siblings").agg((F.min("o") == F.max("o")).alias("_valid")).filter("_valid").drop("_valid")
    return frequent.join(valid, ["host", "siblings"], "left_semi").drop("siblings")


def _regions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.pieces(batches):
        rows = [[(x["t"], x["parent"], x["weight"], x["kind"]) for x in tokens] for tokens in b.column("tokens").to_pylist()]
        regions = [region_of(r) for r in rows]
        texts = [[t for t, _, _, kind in r if kind & TEXT] for r in rows]
        yield pa.RecordBatch.from_arrays([b.column("host"), *(pa.array(x, pa.list_(pa.int64())) for x in (regions, texts))], names=["host", "region", "texts"])


def templates(tokens: DataFrame, bound: int = BROADCAST) -> DataFrame:
    """One row for each host with a template: host, region (paths), texts (the template's own, as tokens)."""
    found = classes(tokens, bound=bound)
    whole = found.groupBy("host").agg(F.collect_list(F.struct("t", "parent", "weight", "kind")).alias("tokens"))
    return whole.mapInArrow(_regions, "host string, region array<long>, texts array<long>")


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in common.pieces(batches, 64):
        out, by = [], []
        for html, region, texts in zip(*(b.column(c).to_pylist() for c in ("html", "region", "texts")), strict=True):
            page = Page(html)
            blocks = page.chosen(region, frozenset(texts or ())) if region else []
            by.append("template" if blocks else "page")
            if not blocks:
                blocks = page.chosen(region_of([(t, p, w, k) for t, p, _, w, k in page.tokens()]))
            out.append("\n\n".join(blocks))
        columns = [*(b.column(c) for c in ("page_id", "url", "host")), pa.array(out, pa.string()), pa.array([len(x) for x in out], pa.int64()), pa.array(by, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "host", "text", "n_chars", "by"])


def extract(pages: DataFrame, bound: int = BROADCAST) -> DataFrame:
    """The main text of every page: page_id, url, text, n_chars, host, and whether its host's template or the page itself gave the region.

    Whole pages are read, also ones that break off or whose tags do not match.
    A null html is empty and an empty page has the text ''; a null url has no
    host and no template; repeated rows each give their row; an empty table
    gives none. Only page_id, url and html are read, so other columns' names
    cannot clash. Whole pages are shuffled only where the hosts' templates are
    beyond ``bound`` bytes, and then no host is in one task.
    """
    common.short_batches(pages.sparkSession)
    host = F.regexp_extract(F.lower("url"), r"^[a-z][a-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1)
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.when(host != "", host).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("_row", F.monotonically_increasing_id())
    tokens = common.stored(rows.filter("host IS NOT NULL").select("host", "_row", "html").mapInArrow(_tokenised, _TOKENS), "tokens")
    found = common.stored(templates(tokens, bound), "templates")
    size = found.select(F.sum(64 + 8 * (F.size("region") + F.size("texts")))).first()[0] or 0
    dealt = _by_host(rows, found, size, bound).select("page_id", "url", "host", "html", "region", "texts")
    made = dealt.mapInArrow(_extracted, "page_id long, url string, host string, text string, n_chars long, by string")
    return made.select("page_id", "url", "text", "n_chars", "host", "by")

"""Main text of web pages by template deduction over equivalence classes.

A page is a row of tokens: tags, told apart by the containers they stand in
(``article/p`` is not ``nav/p``). Over the pages of a host each token has an
occurrence vector, its count on every page. Tokens with the same vector form an
equivalence class; classes that occur on enough pages and have enough tokens are
the template, nested by the containers of their tokens. Each page is cut at the
template's block tags, and what lies between two cuts is a slot. A slot that says the
same on every page is the template's, inside the article too, unless the pages say
the same as a whole; copies of a page count as one page, and a heading over text that varies
is the article's, whatever other articles are headed. The text of the slots that vary is the page's, without
menus, adverts and the like, which elements and whole names tell.

Vectors are never gathered: a token's vector is known by the exclusive or of one
hash for each page and count, which is summed up before and after the shuffle, so
a hot host costs each task one row per token.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sleeper.llm.common import join_sites, keep, map_batches, with_row_id

#: A class belongs to the template from so many pages, share of the host's pages, and tokens on.
MIN_PAGES, MIN_SHARE, MIN_TOKENS = 3, 0.5, 2
#: From this depth on a token names the containers around it by a hash.
DEPTH = 24

# Elements by what HTML makes of them.
RAW = ("script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video")
CONTAINERS = frozenset("""html head body main article section div nav header footer aside form fieldset dialog menu
    ul ol dl table details title select button label textarea datalist""".split())
BLOCKS = CONTAINERS | frozenset("""p h1 h2 h3 h4 h5 h6 li dt dd tr td th caption blockquote pre figure figcaption
    hr address hgroup summary legend thead tbody tfoot option""".split())
NO_TEXT = frozenset("""head title nav footer aside form fieldset dialog menu select button label textarea
    datalist""".split())
MAIN = frozenset(("article", "main"))
UNNAMED = MAIN | {"html", "body"}  # whose names say nothing of what they hold
# A container's class, id or role made of such words only, or of such words and PLACES, says what it is for.
BOILERPLATE = frozenset("""ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion
    cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription paywall signup
    nav navbar navigation menu menubar breadcrumb breadcrumbs pagination pager toolbar sidebar complementary widget
    footer contentinfo masthead search searchbox share sharing social related recommended teaser
    comment comments commentlist disqus respond replies reply""".split())
PLACES = frozenset("""slot box bar list item items area block section container wrapper wrap inner outer unit zone panel
    column col row link links button buttons icon icons top bottom left right primary secondary main site page post posts
    article articles entry global content header form policy message thread""".split())

# Words that decide whatever stands beside them, and words that turn a name's meaning.
STRONG = frozenset("""ad ads advert adverts advertisement advertising adsbygoogle adslot adsense sponsored cookie cookies
    gdpr comment comments commentlist disqus newsletter paywall""".split())
TURNING = frozenset("no not non with without has free off hide hidden disable disabled enable enabled".split())
# Words that together announce other pages.
ELSEWHERE = (frozenset(("more", "also", "most", "other", "latest", "popular", "trending")),
             frozenset(("stories", "story", "articles", "news", "posts", "read", "like", "viewed", "headlines")))
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TOKEN = re.compile(
    rf"(?is)<!--.*?(?:-->|\Z)|<(?:svg|math)\b(?:[^>/]|/(?!>))*+/>|<({'|'.join(RAW)})\b[^>]*+(?:>.*?(?:</\1\s*+>|\Z)|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"""|<(/?)([a-z][a-z0-9:-]*+)((?:[^<>"']++|"[^"<]*+"|'[^'<]*+'|["'])*+)(?:>|(?=<)|\Z)""")
_NAME = re.compile(r"""(?i)\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SIGNS = str.maketrans("/>[]=", "_____")


def boilerplate(name: str) -> bool:
    """Does a whole name say that its container is no text?

    Its words are told by signs, digits and camel case. ``ad-slot``, ``ad-300x250``, ``readerComments`` and
    ``more-stories`` do, ``with-sidebar``, ``no-comments`` and ``post`` don't.
    """
    words = {w.lower() for w in _WORD.findall(name)}
    if words & TURNING:
        return False
    return bool(words & STRONG) or all(words & part for part in ELSEWHERE) or (
        bool(words & BOILERPLATE) and words <= BOILERPLATE | PLACES)


def short(path: str) -> str:
    """A path of bounded length in place of ``path``."""
    return f"/~{xxhash.xxh3_64_hexdigest(path)}"


class Page:
    """A page's containers (number 0 is the page), in page order, and its tokens.

    ``tokens``: (container, token, element, text) of a tag, or (container, None, None, text) of the
    text between. A container's own tag has its path as token, and ends as ``/path``; the
    token of another tag is ``path>tag``.
    """

    def __init__(self, page: str):
        self.paths, self.parents, self.elements = [""], [-1], [""]
        self.named, self.mains, self.chars = [False], [False], [0]
        self.tokens: list[tuple] = []
        stack, add, at = [0], self.tokens.append, 0
        for m in _TOKEN.finditer(page):
            if m.start() > at:
                self._text(stack[-1], page[at:m.start()])
            at = m.end()
            name = m[3]
            if name is None:
                continue
            name = name.lower()
            if m[2]:
                i = 0
                if name in CONTAINERS:
                    i = next((i for i in range(len(stack) - 1, 0, -1) if self.elements[stack[i]] == name), 0)
                if i:
                    path = self.paths[stack[i]]
                    del stack[i:]
                    add((stack[-1], "/" + path, name, None))
                else:
                    add((stack[-1], f"{self.paths[stack[-1]]}>/{name}", name, None))
            elif name in CONTAINERS:
                self._open(stack, name, m[4])
                add((stack[-1], self.paths[stack[-1]], name, None))
            else:
                add((stack[-1], f"{self.paths[stack[-1]]}>{name}", name, None))
        if at < len(page):
            self._text(stack[-1], page[at:])

    def _text(self, node: int, text: str) -> None:
        self.tokens.append((node, None, None, text))
        self.chars[node] += len(text.strip())

    def _open(self, stack: list[int], name: str, attributes: str) -> None:
        found = [(k.lower(), (a or b or c).split()) for k, a, b, c in _NAME.findall(attributes)] \
            if "=" in attributes else []
        marks = "".join(f"[{k}={' '.join(v).lower().translate(_SIGNS)}]" for k, v in found)
        above = self.paths[stack[-1]]
        if len(stack) > DEPTH:
            above = short(above)
        self.paths.append(f"{above}/{name}{marks}")
        self.parents.append(stack[-1])
        self.elements.append(name)
        self.named.append(name not in UNNAMED and any(boilerplate(x) for _, v in found for x in v))
        self.mains.append(name in MAIN or any(k == "role" and "main" in (x.lower() for x in v) for k, v in found))
        self.chars.append(0)
        stack.append(len(self.paths) - 1)

    def roles(self) -> list[bool]:
        """Of each container: is it a part whose text counts? Where there is an article, only what is in one does.

        Names don't speak against a container around the article with the most text.
        """
        n = len(self.paths)
        hard, main, top, size = [False] * n, [False] * n, [0] * n, Counter()
        for i in range(1, n):
            p, name = self.parents[i], self.elements[i]
            hard[i] = hard[p] or name in NO_TEXT or (name == "header" and not main[p])
            main[i] = main[p] or self.mains[i]
            top[i] = top[p] or (i if self.mains[i] else 0)
            if top[i] and not hard[i]:
                size[top[i]] += self.chars[i]
        around, i = set(), max(size, key=lambda k: (size[k], -k)) if size else 0
        while i:
            around.add(i)
            i = self.parents[i]
        drop = [False] * n
        for i in range(1, n):
            drop[i] = hard[i] or drop[self.parents[i]] or self.named[i] and i not in around
        article = any(self.mains[i] and not drop[i] for i in range(1, n))
        return [not drop[i] and (main[i] or not article) for i in range(n)]

    def blocks(self, cuts) -> list[tuple[str, str, bool]]:
        """(slot, text, is it a heading) of each block whose text counts; a slot has the token of the cut before it."""
        counts = self.roles()
        out: list[tuple[str, str, bool]] = []
        block: list[str] = []
        slot, heading = START, False

        def flush():
            text = " ".join(html.unescape("".join(block)).split())
            if text:
                out.append((slot, text, heading))
            block.clear()

        for node, token, name, text in self.tokens:
            if token is None:
                if counts[node]:
                    block.append(text)
            elif name in BLOCKS:
                flush()
                heading = name in HEADINGS and not token.endswith("/" + name)
                if token in cuts:
                    slot = token
            elif name == "br":
                block.append(" ")
        flush()
        return out


#: The slot before the first cut, and the page as a whole.
START, WHOLE = "^", ""


def main_text(page: str, cuts, same) -> str:
    """The text of the page's slots. ``cuts``: the template's tokens; ``same``: the slots that say the same on
    every page. These go; but a heading, which articles may share, goes only with what it is over."""
    blocks = Page(page).blocks(cuts)
    out, varies = [], False  # does the next block that is no heading stay?
    for slot, text, heading in reversed(blocks):
        stays = slot not in same or heading and varies
        if stays:
            out.append(text)
        if not heading:
            varies = stays
    return "\n".join(reversed(out))


# ---------------------------------------------------------------- templates

def host(url: F.Column) -> F.Column:
    """The host in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"(?i)^\s*(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", 1),
                              F.lit("")))


SEEN = "host string, token string, vector long, pages long, place double"


def token_vectors(rows: DataFrame) -> DataFrame:
    """For each host (and for all pages, host ``*``) and token: the hash of its occurrence vector, the
    pages it is on and the sum of its places on them."""

    def run(batches):
        for b in batches:
            seen: dict[tuple[str, str], list] = {}
            for f, r, h, page in zip(*(b[n].to_pylist() for n in ("_file", "_row", "host", "html"))):
                counts, said = Counter(t for _, t, _, _ in Page(page or "").tokens if t is not None), f"{f}:{r}"
                for place, (t, n) in enumerate(counts.items()):
                    vector = xxhash.xxh3_64_intdigest(f"{said}:{n}") - (1 << 63)
                    for key in ((h, t), ("*", t)):
                        s = seen.setdefault(key, [0, 0, 0.0])
                        s[0] ^= vector
                        s[1] += 1
                        s[2] += place / len(counts)
            yield _sums(seen, SEEN)

    return map_batches(rows, run, SEEN, rows=2000).groupBy("host", "token").agg(
        F.bit_xor("vector").alias("vector"), F.sum("pages").alias("pages"), F.sum("place").alias("place"))


def _sums(seen: dict[tuple[str, str], list], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    sums = list(zip(*seen.values())) or [()] * (len(names) - 2)
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _ in seen], pa.string()), pa.array([t for _, t in seen], pa.string()),
         *(pa.array(x, pa.float64() if k == "double" else pa.int64()) for x, k in zip(sums, kinds[2:]))], list(names))


def _pages(rows: DataFrame) -> DataFrame:
    """(host, n): the pages of each host, and of all (host ``*``)."""
    counts = rows.groupBy("host").agg(F.count("*").alias("n"))
    return counts.unionByName(rows.agg(F.lit("*").alias("host"), F.count("*").alias("n")))


def templates(rows: DataFrame) -> DataFrame:
    """(host, pages, template): the tokens of all valid classes in page order, each with its class.

    A class is valid if it has MIN_TOKENS tokens, is on MIN_PAGES pages and on MIN_SHARE of the
    host's. So a template holds no more tokens than a few pages have.
    """
    found = token_vectors(rows).join(_pages(rows), "host").where(
        (F.col("pages") >= MIN_PAGES) & (F.col("pages") >= F.col("n") * MIN_SHARE))
    size = F.count("*").over(Window.partitionBy("host", "vector", "pages"))
    found = found.withColumn("size", size).where(F.col("size") >= MIN_TOKENS)
    return found.groupBy("host").agg(
        F.max("n").alias("pages"),
        F.array_sort(F.collect_list(F.struct(
            (F.col("place") / F.col("pages")).alias("place"), "token", F.col("vector").alias("class")))).alias("template"))


def nest(template: list[dict]) -> frozenset[str]:
    """The tokens of the classes that nest: a token whose containers are not in the template
    themselves has no slot to stand in, and a class left with fewer than MIN_TOKENS goes as a whole."""
    alive = {t["token"]: t["class"] for t in template}
    paths = {short(t): t for t in alive}

    def home(token: str) -> str:
        """The path of the container a token stands in or ends."""
        if ">" in token:
            return token.partition(">")[0]
        if token.startswith("//"):
            return token[1:]
        above = token.rpartition("/")[0]
        return paths.get(above, above)

    homes = {t: home(t) for t in alive}
    while True:
        stands: dict[str, bool] = {"": True}
        for t in alive:
            chain = []
            while t not in stands and t in alive:
                chain.append(t)
                t = homes[t]
            stands.update(dict.fromkeys(chain, stands.get(t, False)))
        sizes = Counter(c for t, c in alive.items() if stands[t])
        left = {t: c for t, c in alive.items() if stands[t] and sizes[c] >= MIN_TOKENS}
        if len(left) == len(alive):
            return frozenset(alive)
        alive = left


SLOTS = "host string, token string, low long, high long, pages long"


def same_slots(joined: DataFrame, counts: DataFrame, common: frozenset[str]) -> DataFrame:
    """(host, same): the slots of each host's template (and of that of all pages, host ``*``) that say the
    same on every page with text in them, which are MIN_PAGES and MIN_SHARE of the host's; none where
    the pages say the same as a whole. ``joined``: host, html, template; ``counts``: host, n."""

    def run(batches):
        nested: dict[str, frozenset] = {}
        for b in batches:
            seen: dict[tuple[str, str], list] = {}
            template = b["template"]
            for i, (h, page) in enumerate(zip(b["host"].to_pylist(), b["html"].to_pylist())):
                parsed = Page(page or "")
                for key, cuts in ((h, _nested(nested, h, template[i], None)), ("*", common)):
                    if cuts is None:
                        continue
                    slots: dict[str, list[str]] = {}
                    for slot, text, _ in parsed.blocks(cuts):
                        slots.setdefault(slot, []).append(text)
                        slots.setdefault(WHOLE, []).append(text)
                    for slot, said in slots.items():
                        digest = xxhash.xxh3_64_intdigest("\n".join(said)) - (1 << 63)
                        s = seen.setdefault((key, slot), [digest, digest, 0])
                        s[0], s[1], s[2] = min(s[0], digest), max(s[1], digest), s[2] + 1
            yield _sums(seen, SLOTS)

    found = map_batches(joined, run, SLOTS, rows=2000).groupBy("host", "token").agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("pages").alias("pages"))
    found = found.where("low = high").join(counts, "host").where(
        (F.col("token") == WHOLE) | (F.col("pages") >= MIN_PAGES) & (F.col("pages") >= F.col("n") * MIN_SHARE))
    return found.groupBy("host").agg(F.collect_list("token").alias("same")).where(~F.array_contains("same", WHOLE))


def _nested(known: dict[str, frozenset], host_name: str, template: pa.Scalar, default):
    """The host's nested template, each worked out once."""
    if host_name not in known:
        if len(known) > 10_000:
            known.clear()
        own = template.as_py()
        known[host_name] = nest(own) if own else default
    return known[host_name]


def distinct_pages(rows: DataFrame) -> DataFrame:
    """``rows`` (_file, _row, host, html) without the copies of pages on their host, which would vouch for each other.
    Only the pages' digests are shuffled to find them."""
    narrow = keep(rows.select("_file", "_row", "host", F.unhex(F.sha2(F.coalesce("html", F.lit("")), 256)).alias("digest")),
                  "page_digests")
    groups = keep(narrow.groupBy("host", "digest").agg(F.count("*").alias("n"), F.min(F.struct("_file", "_row")).alias("one"))
                  .where(F.col("n") > 1), "copied_pages")
    copies = join_sites(narrow, groups, ["host", "digest"], "n").where(F.struct("_file", "_row") != F.col("one"))
    return rows.join(keep(copies.select("_file", "_row"), "page_copies"), ["_file", "_row"], "left_anti")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The main text of every page.

    Returns one row per row of ``pages``: ``_file``, ``_row``, ``page_id``, ``url``,
    ``text``. A null or empty page has the empty text; a page without markup is one
    block. A page of a host with fewer than MIN_PAGES pages, or without a url, is
    read by the template of all pages. Equal rows get equal texts, and copies of a page count once when the
    template is learned, so ties between pages decide nothing. An empty table gives no rows. Pages of
    any length are parsed whole, in one pass over their text. Other columns are not read.
    """
    rows = with_row_id(pages, F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                       F.col(html_col).cast("string").alias("html"), host(F.col(url_col)).alias("host"))
    unlike = distinct_pages(rows.select("_file", "_row", "host", "html"))
    learned = keep(templates(unlike), "templates")
    common = nest((learned.where("host = '*'").select("template").first() or [[]])[0])  # no more than a few pages' tokens
    hosts = learned.where("host != '*' and host != ''").select("host", "template")
    counts = _pages(unlike)
    known = keep(counts.where("host != '*'").join(hosts, "host", "left").select("host", "n", "template"), "hosts")
    same = keep(same_slots(join_sites(unlike.select("host", "html"), known, ["host"], "n").select("host", "html", "template"),
                           counts, common), "slots")
    common_same = frozenset((same.where("host = '*'").select("same").first() or [[]])[0])
    known = keep(known.join(same.where("host != '*'"), "host", "left"), "hosts")

    def run(batches):
        nested: dict[str, frozenset] = {}
        for b in batches:
            template, own = b["template"], b["same"]
            text = []
            for i, (h, page) in enumerate(zip(b["host"].to_pylist(), b["html"].to_pylist())):
                cuts = _nested(nested, h, template[i], None)
                text.append(main_text(page or "", common, common_same) if cuts is None else
                            main_text(page or "", cuts, frozenset(own[i].as_py() or ())))
            yield pa.RecordBatch.from_arrays([b["_file"], b["_row"], b["page_id"], b["url"], pa.array(text, pa.string())],
                                             ["_file", "_row", "page_id", "url", "text"])

    kind = dict(rows.dtypes)
    return map_batches(join_sites(rows, known, ["host"], "n"), run,
                       f"_file long, _row long, page_id {kind['page_id']}, url {kind['url']}, text string")

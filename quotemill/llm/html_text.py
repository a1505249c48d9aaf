"""Main text of web pages by template deduction over the pages of a host.

A page is a sequence of tokens: elements with the path that leads to them, and runs of
text with theirs. Tokens of a host that occur equally often in each of its pages form
an equivalence class; a class is valid if it is frequent and lies in one place of one
other class. Valid classes, nested by their paths, are the host's template, and what
the template leaves open are its slots. The main slot is the element of the template
that holds the article; a page's text is what fills that slot there, without the
elements that are marked as something else and without the runs of the template.

Evidence is what recurs over different articles: pages with the same marked article
count once, whatever stands around it.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotemill.session import materialize

# Element names of HTML by their role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search"
    " section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that hold blocks; those of running text are no steps of a path.
BOXES = frozenset("article body center div html main section td".split())
ARTICLE = frozenset(("article", "main"))
BESIDE = frozenset(
    "aside button canvas dialog footer form head iframe input menu nav noscript object search select svg".split()
)
BESIDE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words of class and id attributes that mark an element as beside the article.
BESIDE_NAMES = frozenset(
    "ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus"
    " footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice popup promo promotion"
    " related replies respond search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
_BEARERS = frozenset(("has", "no", "with", "without"))
_OF_PAGES = frozenset(("banner", "header", "masthead"))
#: An element opened inside one of the first kind ends it, up to an element of the second.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tr"}, {"table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<name>[A-Za-z][^\s/>]*)(?P<rest>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[A-Za-z][^\s/>]*)(?P<rest2>[^>]*)(?:>|\Z)|[^<]+|<",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"(class|id|role|hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?(?=[\s/>]|\Z)", re.IGNORECASE)
_NAME = re.compile(r"[a-z]+|[0-9]+")
#: White space as HTML and Unicode know it.
_SPACE = re.compile(r"\s+")

#: A class is frequent if it is in this part of a host's different pages, and in at least so many.
FREQUENT = 0.5
LEAST_PAGES = 2
#: A run of text in this part of at least so many different pages belongs to the template.
CONSTANT = 0.9
CONSTANT_PAGES = 5
#: Runs of the template may be this part of a host's articles; where they are more, its
#: articles are versions of one, and nothing in them is taken for template.
LABELS = 0.5
#: Part of the open text that a marked element must hold to be the main slot.
MARKED_SHARE = 0.5


@dataclass
class Block:
    """A run of text, the elements it stands in (tokens from the root), and its standing.

    ``opened`` numbers the same elements within the page, in the order of their start tags.
    """

    text: str
    path: tuple[int, ...]
    opened: tuple[int, ...]
    beside: bool
    article: bool


def _hash(*parts) -> int:
    return int.from_bytes(hashlib.blake2b(repr(parts).encode("utf-8", "replace"), digest_size=8).digest(), "big", signed=True)


def _attributes(rest: str) -> dict[str, str]:
    if not rest or rest.isspace():
        return {}
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)}


def _is_beside(name: str, attributes: dict[str, str], in_article: bool) -> bool:
    if name in BESIDE or (name == "header" and not in_article):
        return True
    if not attributes or name in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("role", "").lower() in BESIDE_ROLES:
        return True
    for mark in f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split():
        names = _NAME.findall(mark)
        # A layout "with-sidebar" is none, and an article has a header of its own.
        if names and names[0] not in _BEARERS:
            told = {names[0], names[-1]} - (_OF_PAGES if in_article else set())
            if not told.isdisjoint(BESIDE_NAMES):
                return True
    return False


def blocks(page: str) -> list[Block]:
    """The blocks of text of a whole page in page order, references decoded."""
    out: list[Block] = []
    # name, token, beside, article, counts as a step of the path, number
    stack: list[tuple[str, int, bool, bool, bool, int]] = [("", _hash("page"), False, False, True, 0)]
    opened = 0
    pieces: list[str] = []

    def flush() -> None:
        if pieces:
            text = _SPACE.sub(" ", html.unescape("".join(pieces))).strip()
            pieces.clear()
            if text:
                top = stack[-1]
                steps = [s for s in stack if s[4]]
                out.append(Block(text, tuple(s[1] for s in steps), tuple(s[5] for s in steps), top[2], top[3]))

    def close(names: set[str], until: set[str]) -> None:
        for at in range(len(stack) - 1, 0, -1):
            if stack[at][0] in until:
                return
            if stack[at][0] in names:
                flush()
                del stack[at:]
                return

    at, size = 0, len(page)
    while at < size:
        found = _TOKEN.match(page, at)
        at = found.end()
        name = found["name"] or found["name2"]
        if not name:
            if not found[0].startswith(("<!", "<?")):
                pieces.append(found[0])
            continue
        name = name.lower()
        ending = found["end"] or found["end2"]
        if ending:
            if name in BLOCK:
                flush()
            for place in range(len(stack) - 1, 0, -1):
                if stack[place][0] == name:
                    if stack[place][2] and not stack[place - 1][2]:
                        flush()
                    del stack[place:]
                    break
                # An inline end tag does not reach beyond its block.
                if name not in BLOCK and stack[place][0] in BLOCK:
                    break
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*(?:>|/)", re.IGNORECASE).search(page, at)
            at = page.find(">", end.start()) + 1 if end and page.find(">", end.start()) >= 0 else size
            continue
        if name == "br":
            pieces.append(" ")
            continue
        if name in BLOCK:
            flush()
            close({"p"}, {"article", "main", "section", "div", "td", "th", "li", "button", "body"})
            if name in CLOSES:
                close(*CLOSES[name])
        if name in VOID:
            continue
        rest = found["rest"] if found["name"] else found["rest2"]
        attributes = _attributes(rest)
        top = stack[-1]
        article = top[3] or name in ARTICLE
        beside = top[2] or _is_beside(name, attributes, top[3])
        if beside and not top[2]:
            flush()
        if rest.endswith("/") and name not in BLOCK:
            continue
        step = name in BOXES or beside
        kind = " ".join(sorted(set(re.sub(r"\d+", "", attributes.get("class", "")).split())))
        token = _hash(top[1], name, kind) if step else top[1]
        opened += 1
        stack.append((name, token, beside, article, step, opened))
    flush()
    return out


def page_tokens(page: str) -> tuple[int | None, dict[int, tuple[int, int, int, int, bool, bool, bool]]]:
    """What names the marked article of a page, and the tokens of the page.

    Tokens are token -> (parent, count, open characters, depth, article, beside, text).
    Elements are tokens by their path, runs of text by path and text. Runs count as often
    as they occur, elements as often as they occur with open text in them; those that have
    text only beside the article count as present, those without any are left out. The
    first result is null on a page that marks no article.
    """
    tokens: dict[int, list] = {}
    article: list[str] = []
    met: set[int] = set()
    for block in blocks(page):
        if block.article and not block.beside:
            article.append(block.text)
        for depth, (token, number) in enumerate(zip(block.path, block.opened, strict=True)):
            entry = tokens.setdefault(token, [block.path[depth - 1] if depth else 0, 0, 0, depth, False, block.beside, False])
            if not block.beside and number not in met:
                met.add(number)
                entry[1] += 1
            entry[2] += 0 if block.beside else len(block.text)
            entry[4] |= block.article
            entry[5] &= block.beside
        run = tokens.setdefault(_hash(block.path[-1], "text", block.text), [block.path[-1], 0, 0, len(block.path), block.article, block.beside, True])
        run[1] += 1
        run[2] += 0 if block.beside else len(block.text)
    return _hash(*article) if article else None, {
        token: (parent, max(1, count), *rest) for token, (parent, count, *rest) in tokens.items()
    }


_TOKEN_SCHEMA = (
    "host string, page bigint, token bigint, parent bigint, count int, chars bigint, depth int,"
    " article boolean, beside boolean, run boolean"
)


def host_of(url):
    """The host of a URL in lower case; an empty string for a null or odd URL."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def _innermost(part: pd.DataFrame) -> pd.DataFrame:
    """The innermost element of a host's template that leaves no open text outside it.

    Open is what stands neither in elements beside the article nor in constant runs.
    """
    elements = part[~part["run"]]
    parent = dict(zip(elements["token"], elements["parent"], strict=True))
    left = dict(zip(elements["token"], elements["chars"], strict=True))
    for run in part[part["run"]].itertuples():
        above = run.parent
        while above in left:
            left[above] -= run.chars
            above = parent[above]
    root = elements.loc[elements["depth"] == 0, "token"].iloc[0]
    full = elements[elements["valid"] & ~elements["beside"] & (elements["token"].map(left) == left[root])]
    # With no open text at all, the page as a whole is the slot.
    slot = full.sort_values(["depth", "token"])["token"].iloc[-1] if left[root] and len(full) else root
    return pd.DataFrame({"host": [part["host"].iloc[0]], "inner": [slot]})


def deduce_templates(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Templates of hosts: (tokens with their class, one row per host with its main slot).

    ``pages`` has ``host`` and ``html``. The first result has ``host``, ``token``,
    ``parent``, ``class`` (a fingerprint of the occurrence vector), ``class_parent``, the
    class around it, and what is known of the token. The second has ``host``, ``slot``
    and ``constant``, the runs of text that belong to the template; as each is in nine
    tenths of the pages, they are hardly more than a page has. Runs in marked articles
    are such if nine tenths of the host's different articles have them in that place, and
    if all such runs are at most half of the articles' text.

    Copies of a page, and pages with the same marked article, count once. Occurrence
    vectors are compared by the sum of hashes of (page, count), which is combined before
    the shuffle.
    """

    def tokens(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for host, page, text in zip(batch["host"], batch["page"], batch["html"], strict=True):
                article, found = page_tokens(text)
                page = page if article is None else article
                rows += [(host, page, token, *entry) for token, entry in found.items()]
            names = [c.split()[0] for c in _TOKEN_SCHEMA.split(", ")]
            yield pd.DataFrame(rows, columns=names)

    different = pages.select("host", F.xxhash64("html").alias("page"), "html").where("html IS NOT NULL")
    found = different.mapInPandas(tokens, _TOKEN_SCHEMA)
    # Surroundings of one article may differ; a token's parent, depth and kind can't.
    once = found.groupBy("host", "page", "token").agg(
        *(F.max(c).alias(c) for c in ("parent", "count", "chars", "depth", "article", "run")), F.min("beside").alias("beside")
    )
    vector = F.sum(F.shiftright(F.xxhash64("page", "count"), 24))
    stats = materialize(
        once.groupBy("host", "token").agg(
            F.first("parent").alias("parent"),
            F.count(F.lit(1)).alias("pages"),
            F.count_if("article").alias("articles"),
            vector.alias("class"),
            F.sum("chars").alias("chars"),
            F.first("depth").alias("depth"),
            F.max("article").alias("article"),
            F.min("beside").alias("beside"),
            F.max("run").alias("run"),
        ),
        "template-tokens",
    )
    roots = stats.where("depth = 0 AND NOT run").select(
        "host", F.col("pages").alias("all_pages"), F.col("articles").alias("all_articles"), F.col("chars").alias("all_chars")
    )
    # What stands in articles is measured by the pages that mark one.
    inside = F.col("run") & F.col("article") & ~F.col("beside")
    among = F.when(inside, F.col("all_articles")).otherwise(F.col("all_pages"))
    frequent = (
        stats.join(roots, "host")
        .where((F.col("pages") >= among * FREQUENT) & (F.col("pages") >= F.least(among, F.lit(LEAST_PAGES))))
        .withColumn("inside", inside)
        .withColumn("lasting", F.col("run") & (F.col("pages") >= CONSTANT_PAGES) & (F.col("pages") >= among * CONSTANT))
    )
    # Nesting: a class is valid if its outermost tokens stand in one class only.
    around = frequent.select("host", F.col("token").alias("parent"), F.col("class").alias("class_parent"))
    nested = frequent.join(around, ["host", "parent"], "left")
    outer = nested.where("class_parent IS NULL OR class_parent != class")
    valid = (
        outer.groupBy("host", "class")
        .agg(F.min("class_parent").alias("lo"), F.max("class_parent").alias("hi"))
        .where("lo IS NULL OR lo = hi")
        .select("host", "class", F.col("lo").alias("around"))
    )
    common = nested.join(valid.withColumn("valid", F.lit(True)), ["host", "class"], "left")
    common = common.withColumn("class_parent", F.col("around")).withColumn("valid", F.coalesce("valid", F.lit(False)))
    # Labels in articles are few beside what the articles say.
    said = stats.where(inside).groupBy("host").agg(F.sum("chars").alias("said"))
    labels = common.where("inside AND lasting AND valid").groupBy("host").agg(F.sum("chars").alias("labels"))
    differ = labels.join(said, "host").select("host", (F.col("labels") <= F.col("said") * LABELS).alias("differ"))
    common = common.join(differ, "host", "left").withColumn(
        "steady", F.col("lasting") & F.col("valid") & (~F.col("article") | (F.col("inside") & F.coalesce("differ", F.lit(False))))
    )
    common = materialize(common.drop("around", "lasting", "inside", "differ"), "templates")
    template = common.where("valid").drop("valid", "steady")
    steady = F.col("steady")
    # The outermost element of an article, or else the innermost that leaves no open text out.
    marked = (
        template.where("article AND NOT beside AND NOT run").where(F.col("chars") >= F.col("all_chars") * MARKED_SHARE)
        .groupBy("host")
        .agg(F.min(F.struct("depth", F.col("chars") * -1, "token")).alias("marked"))
    )
    inner = (
        common.where(~F.col("run") | steady)
        .select("host", "token", "parent", "chars", "depth", "beside", "run", "valid")
        .groupBy("host")
        .applyInPandas(_innermost, "host string, inner bigint")
    )
    constant = common.where(steady).groupBy("host").agg(F.array_sort(F.collect_list("token")).alias("constant"))
    slots = (
        inner.join(marked, "host", "left")
        .select("host", F.coalesce("marked.token", "inner").alias("slot"))
        .join(constant, "host", "left")
    )
    return template, slots


def main_text(page: str | None, slot: int | None, constant: frozenset | set) -> str:
    """What fills the slot in this page, without the runs of the template.

    The page's own marks decide where the slot is absent or marked. An article of which
    nothing would be left is kept whole.
    """
    found = [b for b in blocks(page or "") if not b.beside]
    inside = [b for b in found if slot in b.path]
    if not inside or any(b.article for b in inside):
        chosen = [b for b in found if b.article] or inside or found
    else:
        chosen = inside
    kept = [b for b in chosen if _hash(b.path[-1], "text", b.text) not in constant]
    return "\n".join(b.text for b in kept or [b for b in chosen if b.article])


def extract_text(pages: DataFrame) -> DataFrame:
    """All columns of ``pages`` (``url``, ``html`` and others) and ``text``, the main text.

    A null or empty html gives an empty text. A run of text inside a marked article is left
    out if the host repeats it in that place over its different articles ("Share on X").
    Pages with a null or odd URL share the nameless host. A host of a single page has no evidence but the page's own. Repeated
    rows come back as often. Columns of any other
    name are kept, and a column ``text`` is replaced.
    """
    # The caller's columns travel in one, so that no name of theirs meets one used here.
    whole = F.struct(*(F.col(f"`{name}`") for name in pages.columns)).alias("page")
    own = pages.select(whole, host_of(F.col("url")).alias("host"))
    _, slots = deduce_templates(own.select("host", F.col("page.html").alias("html")))
    slots = materialize(slots, "main-slots")
    joined = own.join(slots.select("host", "slot", "constant"), "host", "left")

    @F.pandas_udf("string")
    def fill(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for page, slot, constant in batches:
            yield pd.Series(
                [
                    main_text(p, int(s) if s is not None else None, frozenset(c) if c is not None else frozenset())
                    for p, s, c in zip(page, slot, constant, strict=True)
                ],
                dtype=object,
            )

    # The slot travels as text: a nullable integer would become a floating-point number.
    text = fill(F.col("page.html"), F.col("slot").cast("string"), F.col("constant")).alias("text")
    return joined.select(*(F.col("page")[name].alias(name) for name in pages.columns if name != "text"), text)

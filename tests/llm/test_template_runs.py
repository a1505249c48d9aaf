import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from quotemill.llm import html_text

WORDS = "river stone winter garden market letter engine summer bridge window paper forest".split()


def told(shaker, n=12):
    return " ".join(shaker.choices(WORDS, k=n))


def articles(n, seed=0, share="<p>Share on X</p>", talk="<div class=discussion><h3>Have your say</h3><p>{}</p></div>"):
    """Different articles with a share line, a label and readers' lines inside the mark."""
    shaker = random.Random(seed)
    return [
        f"<body><nav>menu</nav><article><h1>{told(shaker, 5)} {i}</h1><p>{told(shaker)} {i}</p><p>{told(shaker)}</p>"
        f"{share}<p>Read also</p>{talk.format(told(shaker, 6))}</article></body>"
        for i in range(n)
    ]


def extracted(spark, hosts):
    rows = [(f"http://{host}/{n}", page) for host, pages in hosts.items() for n, page in enumerate(pages)]
    out = defaultdict(list)
    for r in html_text.extract_text(spark.createDataFrame(rows, "url string, html string")).orderBy("url").collect():
        out[html_text.re.match(r"http://([^/]+)", r.url)[1]].append(r)
    return out


def test_lines_repeated_over_different_articles_go(spark):
    copies = ["<body><article><h1>Same</h1><p>Same text</p><p>Share on X</p></article>" f"<p>seen {n} times</p></body>" for n in range(9)]
    same = "one long text that every version of this article has word for word and line for line"
    versions = [f"<article><h1>Title</h1><p>{same}</p><p>{same} again</p><p>version {n}</p></article>" for n in range(9)]
    got = extracted(spark, {"many.example": articles(9), "few.example": articles(4), "copies.example": copies, "versions.example": versions})
    for r in got["many.example"]:
        kept = r.text.split("\n")
        assert not {"Share on X", "Read also", "Have your say", "menu"} & set(kept)
        assert len(kept) == 4
    # Four articles are no evidence; nor are copies, whatever stands around them, nor versions of one.
    assert all("Share on X" in r.text and "Read also" in r.text for r in got["few.example"])
    assert {r.text for r in got["copies.example"]} == {"Same\nSame text\nShare on X"}
    assert all(r.text.startswith(f"Title\n{same}\n{same} again\nversion ") for r in got["versions.example"])


def test_lines_of_some_articles_stay(spark):
    pages = articles(8) + articles(8, seed=1, share="")
    got = extracted(spark, {"a.example": pages})["a.example"]
    assert sum("Share on X" in r.text for r in got) == 8
    assert not any("Read also" in r.text for r in got)


def test_articles_beside_pages_without(spark):
    pages = articles(6) + [f"<body><nav>menu</nav><div class=list><p>overview {n}</p></div></body>" for n in range(30)]
    got = extracted(spark, {"a.example": pages})["a.example"]
    assert not any("Share on X" in r.text for r in got)
    assert sum(r.text.startswith("overview") for r in got) == 30


def test_elements_count_as_often_as_they_occur():
    _, tokens = html_text.page_tokens("<body><div class=x>a</div><div class=x>b</div><div class=x>b</div></body>")
    elements = sorted((depth, count) for _, count, _, depth, _, _, run in tokens.values() if not run)
    assert elements == [(0, 1), (1, 1), (2, 3)]
    assert sorted(count for *_, count in [(t, e[1]) for t, e in tokens.items() if e[6]]) == [1, 2]


def deduced(pages):
    """The runs of a host's template, by the rules as they read."""
    vectors, kind, around, by_story = defaultdict(Counter), {}, {}, {}
    for page in pages:
        own = html_text.blocks(page)
        story = tuple(b.text for b in own if b.article and not b.beside) or page
        counts, met = Counter(), set()
        for b in own:
            for depth, (token, number) in enumerate(zip(b.path, b.opened, strict=True)):
                # Elements beside the article are counted as present.
                counts[token] += not b.beside and number not in met
                met |= set() if b.beside else {number}
                around[token] = b.path[depth - 1] if depth else 0
            run = (b.path[-1], b.text)
            counts[run] += 1
            around[run] = b.path[-1]
            kind[run] = b
        held = by_story.setdefault(story, {})
        for token, n in counts.items():
            held[token] = max(held.get(token, 1), n)
    for story, counts in by_story.items():
        for token, n in counts.items():
            vectors[token][story] = n
    marked = [s for s in by_story if isinstance(s, tuple)]
    inside = {t for t, b in kind.items() if b.article and not b.beside}
    among = lambda t: len(marked) if t in inside else len(by_story)
    names = {t: frozenset(v.items()) for t, v in vectors.items()}
    frequent = {t for t, v in vectors.items() if len(v) >= among(t) * 0.5 and len(v) >= min(among(t), 2)}
    parents = defaultdict(set)
    for t in frequent:
        parent = names[around[t]] if around[t] in frequent else None
        if parent != names[t]:
            parents[names[t]].add(parent)
    valid = lambda t: len(parents[names[t]]) == 1 or parents[names[t]] == {None}
    lasting = {t for t in frequent if t in kind and valid(t) and len(vectors[t]) >= 5 and len(vectors[t]) >= among(t) * 0.9}
    size = lambda t: sum(n * len(t[1]) for n in vectors[t].values())
    labels = sum(size(t) for t in lasting & inside)
    differ = labels <= 0.5 * sum(map(size, inside))
    return {html_text._hash(t[0], "text", t[1]) for t in lasting if (t in inside and differ) or not kind[t].article}


def test_templates_equal_those_deduced_plainly(spark):
    shaker = random.Random(3)
    hosts = {}
    for h in range(24):
        pages = []
        labels = [told(shaker, 3) for _ in range(4)]
        for n in range(shaker.randint(3, 14)):
            box = "article" if shaker.random() < 0.8 or h % 3 else "div"
            body = "".join(f"<div class=part><p>{told(shaker, shaker.randint(1, 9))}</p></div>" for _ in range(shaker.randint(1, 3)))
            lines = "".join(f"<p>{label}</p>" for label in labels if shaker.random() < 0.95)
            extra = f"<section class=more><p>{labels[0]}</p></section>" if shaker.random() < 0.9 else ""
            menu = "".join(f"<li>{told(shaker, 1)}</li>" for _ in range(shaker.randint(1, 3)))
            pages.append(f"<body><nav><ul>{menu}</ul></nav><div class=top><p>{labels[1]}</p></div><{box}><h1>{told(shaker, 4)} {n}</h1>{body}{lines}{extra}</{box}><p>{labels[2]}</p></body>")
        pages += shaker.choices(pages, k=3)
        hosts[f"h{h}.example"] = pages
    rows = [(host, page) for host, pages in hosts.items() for page in pages]
    _, slots = html_text.deduce_templates(spark.createDataFrame(rows, "host string, html string"))
    got = {r.host: set(r.constant or ()) for r in slots.select("host", F.col("constant")).collect()}
    want = {host: deduced(pages) for host, pages in hosts.items()}
    assert got == want
    assert sum(map(len, want.values())) > 40

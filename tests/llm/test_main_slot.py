from quotemill.llm import html_text


def texts(spark, bodies):
    rows = [(n, f"http://a.example/{n}", f"<body><div class=menu>m{n}</div><p>Rules of the house</p>{b}</body>") for n, b in bodies]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    return {r.page_id: r.text for r in html_text.extract_text(frame).collect()}


def test_headline_outside_the_body_of_an_article(spark):
    long = "long enough text of a story " * 40
    bodies = [(n, f"<div class=content><h1>Title {n}</h1><div class=entry><p>{n} {long}</p></div></div>") for n in range(8)]
    assert texts(spark, bodies) == {n: f"Title {n}\n{n} {long.strip()}" for n in range(8)}


def test_article_split_over_two_containers(spark):
    bodies = [(n, f"<div class=lead><p>{n} {'a' * 45}</p></div><div class=rest><p>{n} {'b' * 55}</p></div>") for n in range(8)]
    assert texts(spark, bodies) == {n: f"{n} {'a' * 45}\n{n} {'b' * 55}" for n in range(8)}

import duckdb
from pyspark.sql import functions as F

from starward.llm.urls import host_and_path, judge_sql, judge_urls

PAGES = "page_id bigint, url string, html string, tokens string, given string, bad int"
LABELS = "doc_id bigint, quality int, toxic int, page_id string"


def tables(spark, pages, labels):
    return (
        spark.createDataFrame([(i, u, "x", "y", "z", 1) for i, u in pages], PAGES),
        spark.createDataFrame([(*x, "x") for x in labels], LABELS),
    )


def planted():
    pages, labels = [], []
    for i in range(400):
        spam, ads = i % 4 == 0, i % 3 == 0
        host = f"{'spam' if spam else 'news'}{'' if i % 5 else '.WWW'}.example.org"
        pages.append((i, f"https://{host}/{'ads' if ads else 'text'}/{i}?page={i}#x"))
        if i % 2 == 0:
            labels.append((i, 1, 1 if spam and ads else 0))
    return pages, labels


def test_hosts_and_paths(spark):
    cases = {
        "http://A.Example.COM/En/x?y#z": ("a.example.com", "/En/x"),
        "x://h": ("h", ""),
        "://h#f/": ("h", ""),
        "http://h?q/p": ("h", ""),
        "HTTP://ÀB.c:80/a://b": ("Àb.c:80", "/a://b"),
        "no scheme": ("", ""),
        "": ("", ""),
        None: ("", ""),
    }
    df = spark.createDataFrame([(u,) for u in cases], "_url string")
    got = {r[0]: (r[1], r[2]) for r in df.select("_url", *host_and_path(F.col("_url"))).collect()}
    assert got == cases


def test_given_rules(spark):
    want = {
        "http://a.com/x": ("com/", "allow"),
        "http://com/": ("com/", "allow"),
        "http://a.com": (None, "allow"),
        "http://xcom/": (None, "allow"),
        "http://example.com/en/1": ("example.com/en/", "block"),
        "http://m.Example.com/en/1": ("example.com/en/", "block"),
        "http://myexample.com/en/1": ("com/", "allow"),
        "http://www.example.com/en/1": ("www.example.com/en/", "allow"),
        "http://a.www.example.com/en/": ("www.example.com/en/", "allow"),
        "http://example.com/EN/1": ("com/", "allow"),
        "http://b.net/es/": ("net/es/", "block"),
        "http://b.net/fr/x": ("net/fr/", "block"),
        "http://b.net/de/x": (None, "allow"),
        None: (None, "allow"),
    }
    pages, labels = tables(spark, list(enumerate(want)), [])
    got = {r.page_id: (r.rule, r.verdict) for r in judge_urls(pages, labels).collect()}
    assert got == dict(enumerate(want.values()))


def test_mined_combination_blocks_other_pages(spark):
    pages, labels = planted()
    pages += [(1000, "http://spam.example.org/ads/9"), (1001, "http://spam.example.org/text/9"), (1002, "http://news.example.org/ads/9"), (None, pages[0][1])]
    pages += [(1003, None), pages[0]]
    p, l = tables(spark, pages, labels + [(7, None, None), (None, 0, 1)])
    got = judge_urls(p, l).collect()
    assert len(got) == len(pages)
    verdict = {r.page_id: (r.verdict, r.mined_rule) for r in got}
    assert verdict[1000] == ("block", "h:spam p:ads") == verdict[None]
    assert [verdict[i][0] for i in (1001, 1002, 1003)] == ["allow"] * 3
    assert all(verdict[i][0] == ("block" if i % 12 == 0 else "allow") for i in range(400))


def test_sql_says_the_same(spark):
    pages, labels = planted()
    pages += [(900, "http://a.com/x"), (901, "http://b.net/es/"), (902, None), (903, "http://É.org//?&=&b=1#?")]
    p, l = tables(spark, pages, labels)
    got = sorted((tuple(r) for r in judge_urls(p, l).collect()), key=repr)
    db = duckdb.connect()
    for name, rows, columns in (("pages", pages, "page_id, url"), ("labels", labels, "doc_id, quality, toxic")):
        db.execute(f"CREATE TABLE {name} ({', '.join(c + (' VARCHAR' if c == 'url' else ' BIGINT') for c in columns.split(', '))})")
        db.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
    want = db.execute(judge_sql())
    assert [d[0] for d in want.description] == judge_urls(p, l).columns
    assert got == sorted(want.fetchall(), key=repr)


def test_empty_tables(spark):
    assert judge_urls(*tables(spark, [], [(1, 1, 1)])).collect() == []
    assert len(judge_urls(*tables(spark, [(1, "http://x.com/")], [])).collect()) == 1

"""URL parts, rules and templates; the whole query is compared with its SQL in test_mixing.py."""

import random
from collections import defaultdict
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import functions as F

from tidewise.llm import urls
from tidewise.llm.queries import RULES


def test_parts_and_rules(spark):
    cases = {
        "https://WWW.Example.com/en/1?x=/y#z": ("www.example.com", "/en/1", "www.example.com/en/", "allow"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://example.com/enx": ("example.com", "/enx", "com/", "allow"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"),
        "http://x.net?/es/": ("x.net", "", None, "allow"),
        "http://x.org#://y.com/": ("x.org", "", None, "allow"),
        "ftp://com": ("com", "", None, "allow"),
        "://com/": ("com", "/", "com/", "allow"),
        "http://ÄX.com/Ö": ("Äx.com", "/Ö", "com/", "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "own") for i, u in enumerate(cases)], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "url string, good int")
    got = {r.url: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, labels, RULES).collect()}
    assert got == cases
    assert urls.judge(pages.limit(0), labels, RULES).count() == 0


def test_variable_segments_become_wildcards(spark):
    rows = [("h", f"item/name{chr(97 + i % 26)}{chr(97 + i // 26)}/view", 1) for i in range(40)]
    rows += [("h", "about/us", 30), ("h", "about/them", 5), ("g", "x", 1)]
    found = urls.templates(spark.createDataFrame(rows, "host string, shape string, n long")).collect()
    assert {r.template for r in found} == {"/item/*/view", "/about/us", "/about/them", "/x"}


def leaf_scans(df):
    return df._jdf.queryExecution().analyzed().collectLeaves().size()


def plain_templates(rows):
    """The template of every (host, shape): level by level in plain Python."""
    template = {(h, s): "" for h, s, _ in rows}
    for depth in range(urls.DEPTH + 1):
        kinds, pages = defaultdict(set), defaultdict(int)
        below = [(h, s, n, s.split("/")[depth]) for h, s, n in rows if len(s.split("/")) > depth]
        for h, s, n, x in below:
            kinds[h, template[h, s]].add(x)
            pages[h, template[h, s]] += n
        wild = {k for k, v in kinds.items() if len(v) >= urls.KINDS and len(v) >= urls.RARE * pages[k]}
        for h, s, _, x in below:
            at = template[h, s]
            template[h, s] = f"{at}/{'*' if (h, at) in wild and x != '**' else x}"
    return template


def test_plan_of_deep_templates_does_not_double_by_level(spark):
    random.seed(5)
    shapes = {("h", "/".join([f"a{i % 2}", f"n{i}", f"b{i % 3}", "c", f"m{i // 2}", "d", "**"][: 1 + i % 7])) for i in range(400)}
    shapes |= {("g", f"x/{i % 5}/y/{i}") for i in range(60)} | {("g", ""), ("e", ""), ("h", "a0//n")}
    rows = [(h, s, random.choice([1, 1, 1, 2])) for h, s in sorted(shapes)]
    found = urls.templates(spark.createDataFrame(rows, "host string, shape string, n long"))
    assert {(r.host, r.shape): r.template for r in found.collect()} == plain_templates(rows)
    assert len({r.template.count("*") for r in found.collect()}) > 2
    assert leaf_scans(found) == 1
    # Of the levels' tables only the last one stays.
    root = Path(urlparse(found.inputFiles()[0]).path).parents[1]
    before = set(root.glob("url-templates-*"))
    urls.templates(spark.createDataFrame(rows, "host string, shape string, n long"))
    assert len(set(root.glob("url-templates-*")) - before) == 1


def test_no_job_has_a_plan_that_doubles_by_level(spark, monkeypatch):
    scans, write = [], urls.stored
    monkeypatch.setattr(urls, "stored", lambda df, *a: scans.append(leaf_scans(df)) or write(df, *a))
    pages = spark.createDataFrame([(i, f"http://h.org/a/b/c/d/e/f/{i}") for i in range(50)], "page_id long, url string")
    labels = pages.select("url", F.lit(1).alias("good"))
    judged = urls.judge(pages, labels, RULES)
    assert judged.count() == 50 and max([*scans, leaf_scans(judged)]) <= 8


def test_shapes(spark):
    paths = ["/a/12/b3.html", "/", "", "/1/2/3/4/5/6/7/8", "/x//y/"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert [r[0] for r in df.select(urls.shape(F.col("path"))).collect()] == ["a/#/b#.html", "", "", "#/#/#/#/#/#/**", "x//y/"]


def test_bad_branches_are_blocked_and_similar_ones_share_their_labels(spark):
    good = [(f"http://h.org/good/{i}", 1) for i in range(60)]
    bad = [(f"http://h.org/bad/{i}", 0) for i in range(60)]
    few = [(f"http://k.org/{name}/{i}", 0 if i < 9 else 1) for name in "abc" for i in range(10)]
    rows = [(i, u) for i, (u, _) in enumerate(good + bad + few)]
    pages = spark.createDataFrame([*rows, (999, "http://h.org/other")], "page_id long, url string")
    labels = spark.createDataFrame([*good, *bad, *few, ("http://h.org/good/1", None)], "url string, good int")
    got = {r.page_id: r for r in urls.judge(pages, labels, []).collect()}
    assert {got[i].verdict for i in range(60)} == {"allow"} and {got[i].verdict for i in range(60, 120)} == {"block"}
    assert len({got[i].purity for i in range(120, 150)}) == 1 and got[120].verdict == "block"
    assert got[999].purity > 0 and len(got) == len(rows) + 1

"""Wrappers decide: without hints in tags and classes, at any width, in any order of pages."""

import collections
import json
import random
import re

import pyarrow.parquet as pq
import pytest
from conftest import MEDIUM, SMALL
from pyspark.sql import functions as F

from firstmile.llm import html


def without_hints(source):
    """The page with plain containers for telling ones, and no class, id or role."""
    plain = re.sub(r"<(/?)(article|nav|footer|main|header|aside|section)\b", r"<\1div", source)
    return re.sub(r"\s(class|id|role)=(\"[^\"]*\"|\S+?(?=[\s>]))", "", plain)


def texts(pages):
    whole = None
    for page in pages:
        whole = html.merged(whole, html.wrapper(html.parse(page)))
    found = json.loads(json.dumps(html.rules(whole)))
    return [html.main_text(page, found) for page in pages]


@pytest.fixture(scope="module")
def hosts():
    out = collections.defaultdict(list)
    for row in pq.read_table(f"{MEDIUM}/pages.parquet").to_pylist():
        out[html.host(row["url"])].append(row["html"])
    return out


def test_articles_without_hints(hosts):
    article = re.compile(r"<article>(.*)</article>", re.DOTALL)
    right = total = 0
    for pages in hosts.values():
        want = [html.main_text(f"<article>{article.search(p)[1]}</article>", None) for p in pages]
        assert texts(pages) == want
        bare = texts([without_hints(p) for p in pages])
        right, total = right + sum(a == b for a, b in zip(want, bare, strict=True)), total + len(pages)
        if len(pages) > 1:
            assert bare == want
    assert total == 250 and right >= 0.95 * total


@pytest.mark.parametrize("n", [5, 100, 520, 5000])
@pytest.mark.parametrize("block", ["<div class=x{c}>text {i} of it</div>", "<div class=x{c}><p>text {i} of it</p></div>", "<p>text {i}</p><h2>{i}</h2>"])
def test_a_notice_goes_at_any_width(n, block):
    """Pages of n, n - 1 and n - 2 blocks beside a constant notice."""
    name = lambda i: "".join(chr(97 + int(d)) for d in str(i))
    pages = []
    for k in range(3):
        body = "".join(block.format(c=name(i), i=f"{k} {i}") for i in range(n - k))
        pages.append(f"<body><div class=site>Follow this site</div>{body}</body>")
    for k, found in enumerate(texts(pages)):
        lines = found.split("\n")
        assert "Follow this site" not in lines
        assert len(lines) == (n - k) * (2 if "h2" in block else 1) and f"{k} {n - k - 1}" in lines[-1]


def random_page(draw):
    def group(depth):
        tag = draw.choice(["div", "div", "p", "ul", "section", "h2"])
        name = draw.choice(["", "", " class=a", " class=b", " class=c"])
        inner = "".join(group(depth - 1) for _ in range(draw.randrange(4))) if depth and tag in ("div", "section") else draw.choice(["x", "y", "a longer text", "same"])
        return f"<{tag}{name}>{inner}</{tag}>"

    return "<body>" + "".join(group(2) for _ in range(draw.randrange(1, 6))) + "</body>"


def test_rules_do_not_depend_on_files_or_tasks(spark):
    draw = random.Random(5)
    rows = [(k, f"http://h{k % 40}.example/{k}", random_page(draw)) for k in range(200)]
    found = []
    for tasks, seed in ((1, 1), (3, 2), (7, 3)):
        random.Random(seed).shuffle(rows)
        pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(tasks)
        found.append({r["_host"]: (r["rules"], r["pattern"]) for r in html.wrappers(pages).collect()})
    assert len(found[0]) == 40 and found[0] == found[1] == found[2]


@pytest.mark.parametrize("bits", [0, 16, 1 << 28])
def test_alignment_is_a_longest_common_subsequence(monkeypatch, bits):
    monkeypatch.setattr(html, "BITS", bits)
    draw = random.Random(2)
    for _ in range(200):
        a, b = ([draw.choice("abcde") for _ in range(draw.randrange(12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        pairs = html._common(a, b)
        assert len(pairs) == best[-1][-1] and all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_a_notice_longer_than_any_paragraph_goes():
    notice = "<div class=site>" + "This site is read by many people from many places. " * 5 + "</div>"
    pages = [f"<body>{notice}<div class=story><p>First words of {k}.</p><p>Second words of {k}.</p><p>Third of {k}</p></div></body>" for k in range(3)]
    assert texts(pages) == [f"First words of {k}.\nSecond words of {k}.\nThird of {k}" for k in range(3)]


def test_copies_with_another_date_keep_their_text():
    story = "<div class=story><p>The one long paragraph of the article.</p><p>And a second, shorter one.</p><p>More</p></div>"
    pages = [f"<body><div class=day>{k} May</div>{story}</body>" for k in range(3)]
    assert all(x.endswith("The one long paragraph of the article.\nAnd a second, shorter one.\nMore") for x in texts(pages))


def test_short_blocks_with_a_class_stay_beside_prose():
    pages = [f"<body><div class=intro>In short {k}</div><div><h1>T{k}</h1><p>{'long text ' * 40}{k}</p><p>a{k}</p></div></body>" for k in range(4)]
    assert all(x.startswith(f"In short {k}\nT{k}") for k, x in enumerate(texts(pages)))


def test_pages_do_not_move(spark):
    """The rules go to the pages, by broadcast where their size allows it."""
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    plan = html.extract(pages)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan.split("BroadcastExchange")[0]


def test_pages_of_too_many_hosts_are_joined(spark, monkeypatch):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    want = sorted(map(tuple, html.extract(pages).collect()))
    monkeypatch.setattr(html, "SENT", -1)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        df = html.extract(pages.withColumn("_host", F.lit("x")))
        assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, df.collect())) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)

"""Operators on pages, vectors and conversations against plain Python versions."""

import hashlib
import json
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pricehouse.llm import chat_format, url_filters, vector_search
from pricehouse.llm.components import components

# components


@pytest.mark.parametrize("shape", ["chain", "star", "random", "none"])
def test_components(workers, shape):
    import random

    rng = random.Random(2)
    edges = {
        "chain": [(i + 1, i) for i in range(60)],
        "star": [(500, i) for i in range(300)] + [(7, 7)],
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "none": [],
    }[shape]
    group = {n: n for e in edges for n in e if e[0] != e[1]}

    def root(n):
        while group[n] != n:
            n = group[n]
        return n

    for a, b in edges:
        if a != b:
            x, y = sorted((root(a), root(b)))
            group[y] = x
    df = workers.createDataFrame([*edges, (None, 1), *edges[:3]], "a bigint, b bigint")
    got = [(r["node"], r["component"]) for r in components(df, "a", "b").collect()]
    assert sorted(got) == sorted((n, root(n)) for n in group)


# urls

PAGES = [
    (1, "https://A.Example.NET/en/x", None),
    (2, "http://foo.net", "<p>none</p>"),
    (3, "http://foo.net/en/", None),
    (4, "x", None),
    (5, None, "<link rel=canonical href='http://foo.net/'>"),
    (6, "http://clean.io/a#top", '<LINK href="//foo.net" REL="canonical">'),
    (7, "https://clean.io/b", '<meta http-equiv="refresh" content="0; url=/a">'),
    (8, "http://other.io/dir/p?q=1", '<link rel="canonical" href="q">'),
    (9, "http://other.io/dir/q", '<link rel="canonical" href="http://w.org/fr/1"><meta http-equiv=refresh content="1;URL=http://foo.net/z">'),
    (10, "http://alone.io?x=/net/", ""),
    (11, "http://deep.example.com/de/1", None),
    (12, "http://org/fr/", None),
    (13, "http://notorg/fr/", None),
    (13, "http://notorg/fr/", None),
]
PAGE_SCHEMA = "page_id bigint, url string, html string, host string, node string, component string, verdict string"


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "h", "n", "c", "v") for r in rows], PAGE_SCHEMA)


def test_url_verdicts(workers):
    got = url_filters.filter_urls(pages(workers)).collect()
    assert len(got) == len(PAGES)
    assert {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got} == {
        1: ("a.example.net", "/en/x", "example.net/en/", "allow"),
        2: ("foo.net", "", None, "block"),  # without a path no rule fits, but it is an alias of blocked pages
        3: ("foo.net", "/en/", "net/", "block"),
        4: ("", "", None, "allow"),
        5: ("", "", None, "allow"),
        6: ("clean.io", "/a", None, "block"),
        7: ("clean.io", "/b", None, "block"),
        8: ("other.io", "/dir/p", None, "allow"),  # its component holds a blocked and an allowed alias
        9: ("other.io", "/dir/q", None, "allow"),
        10: ("alone.io", "", None, "allow"),
        11: ("deep.example.com", "/de/1", "example.com/de/", "block"),
        12: ("org", "/fr/", "org/fr/", "allow"),
        13: ("notorg", "/fr/", None, "allow"),
    }


def test_observed_redirects_and_empty_tables(workers):
    seen = workers.createDataFrame([("http://alone.io?x=/net/", "http://bad.net/1"), (None, "http://a.b/")], "from_url string, to_url string")
    said = {r["page_id"]: r["verdict"] for r in url_filters.filter_urls(pages(workers), redirects=seen).collect()}
    assert said[10] == "block"
    assert url_filters.filter_urls(pages(workers, [])).count() == 0
    kept = url_filters.keep_allowed(pages(workers))
    assert kept.columns == pages(workers).columns and {r["page_id"] for r in kept.collect()} == {1, 4, 5, 8, 9, 10, 12, 13}


def plain_verdicts(rows, rules):
    """Verdicts and components worked out with Python's own html and url libraries."""
    from html.parser import HTMLParser
    from urllib.parse import urljoin, urlsplit

    def node(url):
        if "://" not in (url or ""):
            return None
        split = urlsplit("http://" + url.split("://", 1)[1])
        path = urlsplit(urljoin("http://h/", "http://h" + (split.path or "/"))).path
        path = urlsplit(urljoin("http://h/", path)).path or "/"
        return split.netloc.lower() + path + (f"?{split.query}" if "?" in url.split("#")[0] else "") if split.netloc else None

    def own(host, path):
        fits = [(len(r), r, v) for r, v in rules
                if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0])) and path.startswith("/" + r.split("/", 1)[1])]
        return max(fits)[1:] if fits else (None, None)

    group = {}

    def root(n):
        group.setdefault(n, n)
        while group[n] != n:
            n = group[n]
        return n

    for _, url, html in rows:
        targets = []

        class Links(HTMLParser):
            def handle_starttag(self, tag, attrs):
                a = dict(attrs)
                if tag == "link" and (a.get("rel") or "").lower() == "canonical":
                    targets.append(a.get("href"))
                if tag == "meta" and (a.get("http-equiv") or "").lower() == "refresh":
                    targets.append((a.get("content") or "").partition("=")[2].strip("'\" "))

        Links().feed(html or "")
        if node(url):
            root(node(url))
            for t in filter(None, targets):
                full = urljoin(url, t.strip())
                if full.startswith("http") and not t.startswith("#") and node(full):
                    group[root(node(full))] = root(node(url))
    members = defaultdict(list)
    for n in list(group):
        members[root(n)].append(n)
    shared = {}
    for nodes in members.values():
        said = {own(n.partition("/")[0], "/" + n.partition("/")[2].partition("?")[0])[1] for n in nodes}
        for n in nodes:
            shared[n] = (min(nodes), "allow" if "allow" in said else "block" if "block" in said else "allow")
    out = []
    for page, url, _ in rows:
        n = node(url)
        rest = url.split("://", 1)[1].split("#")[0].split("?")[0] if n else ""
        host = rest.partition("/")[0]
        path = rest[len(host):]
        rule, verdict = own(host.lower(), path)
        component, method = shared.get(n, (None, "allow"))
        out.append((page, host.lower(), path, rule, verdict or method, component))
    return sorted(out, key=str)


LINK_CASES = [
    ("http://a.io/x", "<link rel='canonical' href='/out?u=http://bad.net/1'>"),
    ("http://a.io/out?u=http://bad.net/1", ""),
    ("http://b.io/d/p?a=1&b=2", ""),
    ("http://b.io/d/q", '<link rel="canonical" href="p?a=1&amp;b=2">'),
    ("http://b.io/d/e/r", '<link rel=canonical href="../q">'),
    ("http://b.io/d/e/../q", '<link href="?z=1" rel=canonical>'),
    ("http://c.net", ""),
    ("http://c.net/", ""),
    ("http://d.io/s", '<link rel="canonical" href="mailto:x@c.net"><link rel="canonical" href="#top">'),
    ("http://d.io/t", '<meta http-equiv="refresh" content="3; url=https://c.net/./u">'),
    ("http://d.io/f", "<meta http-equiv='Refresh' content=\"0;url='//w.org/fr/'\">"),
    ("http://d.io", '<link rel="canonical" href="&#47;t">'),
]


@pytest.mark.parametrize("count", [0, 3000])
def test_linked_pages_with_hubs(workers, count):
    import random

    rng = random.Random(count)
    rows = [(i, *case) for i, case in enumerate(LINK_CASES)]
    hosts = [f"h{i}.io" for i in range(40)] + ["x.bad.net", "w.org", "shop.example.com"]
    urls = [f"http://{rng.choice(hosts)}/{rng.choice(['', 'de/', 'fr/', 'en/'])}{i}" for i in range(count)]
    for i, url in enumerate(urls):
        target = rng.choice(urls[:4]) if rng.random() < 0.1 else rng.choice(urls) if rng.random() < 0.3 else None
        html = None if target is None else rng.choice([f'<link rel="canonical" href="{target}">', f"<meta http-equiv=refresh content='0; url={target}'>"])
        rows.append((100 + i, url, html))
    columns = ["page_id", "host", "path", "rule", "verdict", "component"]
    got = url_filters.filter_urls(pages(workers, rows)).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == plain_verdicts(rows, url_filters.RULES)
    long = list(url_filters.RULES) + [(f"r{i}.example.org/{'p' * (i % 7)}", "block") for i in range(1200)] + [(f"h1.io/{i}", "block") for i in range(0, 900, 2)]
    got = url_filters.filter_urls(pages(workers, rows), long).select(*columns).collect()
    assert sorted(map(tuple, got), key=str) == plain_verdicts(rows, long)


@pytest.mark.parametrize("linked", [False, True])
def test_sql_of_linked_pages(workers, linked, tmp_path):
    """The DuckDB statement of the query, on pages that have links."""
    import duckdb

    from pricehouse.llm import queries

    rows = [(i, *case) for i, case in enumerate(LINK_CASES) if "&#47;" not in case[1]] + (PAGES[:12] if linked else [])
    rows = [(i, url, html) for i, (_, url, html) in enumerate(rows)]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    columns = ["page_id", "host", "path", "rule", "verdict", "component"]
    got = url_filters.filter_urls(pages(workers, rows)).select(*columns).collect()
    said = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.ORACLES['op3_url_filters']}) x").fetchall()
    assert sorted(map(tuple, got), key=str) == sorted(said, key=str)


# vectors


def plain_nearest(ids, vectors, query, k=10):
    own = vectors[ids.index(query)]
    found = sorted({(float(np.sqrt(((v - own) ** 2).sum())), i) for i, v in zip(ids, vectors) if i != query})
    return [(i, d) for d, i in found[:k]]


def searched(df, **options):
    from pyspark.sql import functions as F

    out = defaultdict(list)
    for r in vector_search.search(df, F.col("vec_id") % 100 == 0, **options).orderBy("query_id", "rank").collect():
        out[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


VECTORS = "vec_id bigint, embedding array<float>, list string, score double, query string"


@pytest.mark.parametrize("block", [8192, 40])
def test_search_recall_and_scores(workers, block):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(900, 32)).astype("f4")
    vectors[100:400] = vectors[100]  # a third of all rows is one vector
    rows = [(i, v.tolist(), "x", 0.0, "q") for i, v in enumerate(vectors)]
    got = searched(workers.createDataFrame(rows, VECTORS), block=block)
    ids, exact = list(range(900)), vectors.astype("f8")
    hits = 0
    for q in range(0, 900, 100):
        wanted = plain_nearest(ids, exact, q)
        hits += len({i for i, _ in wanted} & {i for i, _ in got[q]})
        for i, d in got[q]:
            assert d == pytest.approx(float(np.sqrt(((exact[i] - exact[q]) ** 2).sum())), abs=1e-12)
    assert hits >= 0.9 * 90
    assert [i for i, _ in got[100]] == list(range(101, 111))  # ties go by smaller id


def test_search_of_odd_vectors(workers):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [0.0, 0.0]), (3, None), (4, [None, 1.0]), (5, [inf, 1.0]), (6, [nan, 1.0]),
        (7, [1.0, 0.0]), (1, [1.0, 0.5]), (0, [1.0, 0.0]), (100, [0.0, 0.0]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (9, []),
    ]
    df = workers.createDataFrame([(*r, "x", 0.0, "q") for r in rows], VECTORS)
    assert searched(df) == {0: [(7, 0.0), (1, 0.5)]}
    assert not searched(df.limit(0)) and not searched(df.filter("vec_id = 2"))


# conversations


def test_layouts():
    same = [("user", "hi"), ("assistant", "yo")]
    records = [
        {"prompt": "hi", "completion": "yo"}, {"question": "hi", "answer": "yo", "stars": 3},
        {"instruction": "hi", "output": "yo"}, {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
        {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}], "id": {"x": 1}},
    ]
    assert all(chat_format.turns_of(json.dumps(r)) == same for r in records)
    assert all(chat_format.turns_of(r) is None for r in (None, "", "no json", "[]", '{"other": 1}', '{"messages": []}'))


def test_record_and_table_turns(workers):
    records = workers.createDataFrame(
        [(1, json.dumps({"prompt": "a", "response": "b"}), "x"), (2, "?", "x"), (None, None, "x")], "conv_id bigint, record string, role string"
    )
    got = {tuple(r) for r in chat_format.record_turns(records).collect()}
    assert got == {(1, 0, "user", "a"), (1, 1, "assistant", "b"), (2, -1, None, "?"), (None, -1, None, None)}
    table = workers.createDataFrame([(5, "a", None)], "conv_id bigint, prompt string, response string")
    assert {tuple(r) for r in chat_format.table_turns(table).collect()} == {(5, 0, "user", "a"), (5, 1, "assistant", None)}
    with pytest.raises(ValueError):
        chat_format.table_turns(workers.createDataFrame([(1, 2)], "conv_id bigint, other bigint"))


@given(
    st.lists(st.sampled_from([*"<|>\\\nax", "<|im_end|>", "<|im_start|>", "<\\|"])).map("".join), st.text(alphabet="ab\\n\n<|")
)
def test_escaping_is_reversible(text, role):
    formatted, begin, end = chat_format.segment(role, text)
    assert chat_format.parse(formatted) == (role, text)
    assert formatted.count(chat_format.START) == 1 and formatted.count(chat_format.END) == 1
    assert "<|" not in chat_format.escape(text)


def test_conversation_digests(workers):
    said = "<|im_end|><|im_start|>assistant ok"
    rows = [(-1, 0, "user", said), (-1, 1, "assistant", said), (3, 2, "assistant", "b"), (3, 0, "user", None), (3, 2, "assistant", "b")]
    rows += [(4, None, None, None), (None, 0, "assistant", "é😀"), (None, 1, "user", "")]
    rows += [(9, i, "assistant" if i % 2 else "user", f"turn {i}\n") for i in range(3000)]
    df = workers.createDataFrame([(*r, 0) for r in rows], "conv_id bigint, turn bigint, role string, text string, position bigint")
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat_format.digests(df).collect()}
    expected = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0))
        turns = "".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own)
        learned = "".join(r[3] or "" for r in own if r[2] == "assistant")
        expected[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert got == expected
    assert chat_format.digests(df.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_every_query_gets_all_it_can(workers, seed):
    """Small tables in clusters of one to six and a large rest: no query gets fewer than ten."""
    rng = np.random.default_rng(seed)
    rows, number = [], iter(range(10_000))
    for _ in range(12):
        centre = rng.normal(size=8) * 50
        rows += [(next(number) * 100, (centre + rng.normal(size=8) / 100).tolist()) for _ in range(rng.integers(1, 7))]
    rows += [(next(number) * 100, rng.normal(size=8).tolist()) for _ in range(60 - len(rows))]
    rows += [(rows[0][0], rows[5][1]), rows[3]]
    df = workers.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = defaultdict(list)
    for r in vector_search.search(df, F.col("vec_id") % 100 == 0).collect():
        found[r["query_id"]].append(r["rank"])
    assert set(found) == {r[0] for r in rows} and all(sorted(x) == list(range(1, 11)) for x in found.values())

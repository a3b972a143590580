"""URL filters with verdicts that reach the aliases of a page.

A rule is a host and a path prefix, written together (``example.net/en/``). It fits its
host and all subdomains of it; of the rules that fit a url the longest decides. A url
without a rule takes the verdict of its redirect component: urls are nodes, redirects
(meta refresh in the page, or a table of observed redirects) and canonical links are
edges, and connected components are the sets of aliases. In a component allow goes before
block: one allowed alias clears the others, else one blocked alias blocks them. What is left is
allowed.

A node is a url without scheme and fragment, the host in lower case, an empty path as ``/`` and
dot segments resolved, so the same page under http and https is one node. Every url without a
rule takes the verdict of its node, linked or not: that of its component, in which the node's own
rule takes part. So spellings of one page have one verdict.

Link targets are read as browsers do: HTML references are decoded, a scheme counts only at
the start, and ``//host``, ``/path``, ``?query`` and relative targets are seen from the page's
url. Targets of other schemes and mere fragments are no links.

Defined cases: a NULL url, or one without ``://``, has an empty host and path, fits
no rule, is no node and is allowed; a NULL html has no links; very long pages are searched
whole; rules of one length that fit (one is the other's subdomain, say) go to the greater text; repeated
rows and urls are judged alike; empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricehouse.llm.components import components
from pricehouse.llm.text import column, pick
from pricehouse.session import materialize

#: The production rules: (rule, verdict).
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)

#: Up to so many rules become one expression; a longer list is a table that urls are joined with.
MOST_RULES = 1000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)([^#]*)"
LINK_PATTERN = r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>"
REFRESH_PATTERN = r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>"
HREF_PATTERN = r"(?is)\bhref\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
CONTENT_PATTERN = r"(?is)\bcontent\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^>\"']+))"
TARGET_PATTERN = r"(?is)\burl\s*=\s*[\"']?([^\"'>]*)"

#: HTML references by name, and the ASCII letters that numeric ones may stand for.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&"))


def _part(url: Column, number: int) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, number), F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(_part(url, 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return _part(url, 2)


def without_dots(path: Column) -> Column:
    """A path from the root with its ``.`` and ``..`` segments resolved."""
    parts = F.split(F.substring(path, 2, 1 << 30), "/", -1)
    kept = F.aggregate(
        parts, F.array().cast("array<string>"),
        lambda a, x: F.when(x == "..", F.slice(a, F.lit(1), F.greatest(F.size(a) - 1, F.lit(0)))).when(x == ".", a).otherwise(F.array_append(a, x)),
    )
    # A path that ends in dots is a folder.
    closed = F.when(F.element_at(parts, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(closed, "/"))).otherwise(path)


def node_of(url: Column) -> Column:
    """The url as a node; NULL where it has no host."""
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(without_dots(path_of(url)))
    return F.when(host_of(url) != "", F.concat(host_of(url), path, _part(url, 3)))


def _fitting(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, NULL without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, say in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest is asked first
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(rule, verdict) rows; a long list is best kept as such a table from the start."""
    return spark.createDataFrame(list(rules), "rule string, verdict string")


def with_rules(urls: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame) -> DataFrame:
    """Adds ``rule`` and ``own_verdict``, the longest rule that fits ``host`` and ``path``, to ``urls``.

    A long list of rules is a join: a host asks with each of its suffixes, and with as many
    letters of its path as some rule of that suffix has. So a url meets only the rules that fit
    it, whatever their number, and rules of one busy host are not tried one by one.
    """
    if not isinstance(rules, DataFrame) and len(rules) <= MOST_RULES:
        rule, verdict = _fitting(F.col("host"), F.col("path"), rules)
        return urls.select("*", rule.alias("rule"), verdict.alias("own_verdict"))
    listed = rules if isinstance(rules, DataFrame) else rule_table(urls.sparkSession, rules)
    name = F.substring_index("rule", "/", 1)
    split = listed.select(
        F.col("rule"), F.col("verdict"), name.alias("rule_host"), F.substring(F.col("rule"), F.length(name) + 1, F.lit(1 << 30)).alias("rule_path")
    ).dropDuplicates(["rule"])
    lengths = split.groupBy(F.col("rule_host").alias("of_host")).agg(F.collect_set(F.length("rule_path")).alias("lengths"))
    asked = urls.filter("host <> ''").select("host", "path").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    tried = asked.select("host", "path", F.explode(suffixes).alias("suffix")).join(lengths, F.col("suffix") == F.col("of_host"))
    tried = tried.select("host", "path", "suffix", F.explode(F.filter("lengths", lambda n: n <= F.length("path"))).alias("n"))
    tried = tried.select("host", "path", "suffix", F.left("path", F.col("n")).alias("start"))
    met = tried.join(split, (F.col("suffix") == F.col("rule_host")) & (F.col("start") == F.col("rule_path")))
    best = met.groupBy(F.col("host").alias("of_host"), F.col("path").alias("of_path")).agg(
        F.max(F.struct(F.length("rule").alias("n"), "rule", "verdict")).alias("best")
    )
    joined = urls.join(best, (F.col("host") == F.col("of_host")) & (F.col("path") == F.col("of_path")), "left")
    return joined.select(*[column(c) for c in urls.columns], F.col("best.rule").alias("rule"), F.col("best.verdict").alias("own_verdict"))


def judged_by_rules(pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame = RULES) -> DataFrame:
    """page_id, url, host, path, rule and own_verdict of every row."""
    split = pick(pages, ["page_id", "url"]).select(
        "page_id", "url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")
    )
    return with_rules(split, rules)


def decoded(text: Column) -> Column:
    """HTML references in a link target replaced by their letters, as far as urls need them."""
    numeric = F.regexp_extract_all(text, F.lit(r"&#([xX][0-9a-fA-F]+|[0-9]+);"), F.lit(1))

    def put(acc: Column, said: Column) -> Column:
        code = F.when(F.lower(said).startswith("x"), F.conv(F.substring(said, 2, 16), 16, 10)).otherwise(said)
        code = F.try_to_number(F.lpad(code, 9, "0"), F.lit("999999999")).cast("int")
        return F.when(code.between(33, 126), F.replace(acc, F.concat(F.lit("&#"), said, F.lit(";")), F.char(code))).otherwise(acc)

    out = F.when(text.contains("&#"), F.aggregate(numeric, text, put)).otherwise(text)
    for name, letter in REFERENCES:
        out = F.replace(out, F.lit(name), F.lit(letter))
    return out


def _absolute(target: Column, url: Column) -> Column:
    """A link target seen from the page; NULL where it is none."""
    base = F.concat(F.lit("x://"), host_of(url))
    path = F.when(path_of(url) == "", F.lit("/")).otherwise(path_of(url))
    return (
        F.when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), target)
        .when(target.rlike("^[A-Za-z][A-Za-z0-9+.-]*:") | target.startswith("#"), F.lit(None))
        .when(target.startswith("//"), F.concat(F.lit("x:"), target))
        .when(target.startswith("/"), F.concat(base, target))
        .when(target.startswith("?"), F.concat(base, path, target))
        .otherwise(F.concat(base, F.regexp_extract(path, r"(?s)^(.*/)", 1), target))
    )


def _either(text: Column, pattern: str) -> Column:
    """What one of the three groups of a quoted value matches."""
    return F.concat(*[F.coalesce(F.regexp_extract(text, pattern, i), F.lit("")) for i in (1, 2, 3)])


def page_links(pages: DataFrame) -> DataFrame:
    """(from_node, to_node) of the canonical links and refresh redirects inside the pages."""
    html = F.coalesce(F.col("html"), F.lit(""))
    found = F.concat(
        F.transform(F.regexp_extract_all(html, F.lit(LINK_PATTERN), F.lit(0)), lambda t: _either(t, HREF_PATTERN)),
        F.transform(
            F.regexp_extract_all(html, F.lit(REFRESH_PATTERN), F.lit(0)),
            lambda t: F.regexp_extract(_either(t, CONTENT_PATTERN), TARGET_PATTERN, 1),
        ),
    )
    tags = pick(pages, ["url", "html"]).select("url", F.explode(found).alias("target"))
    seen = tags.select("url", F.trim(decoded(F.col("target"))).alias("target")).filter("target <> ''")
    ends = seen.select(node_of(F.col("url")).alias("from_node"), node_of(_absolute(F.col("target"), F.col("url"))).alias("to_node"))
    return ends.filter("from_node IS NOT NULL AND to_node IS NOT NULL")


def filter_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str]] | DataFrame = RULES, redirects: DataFrame | None = None
) -> DataFrame:
    """page_id, url, host, path, rule, verdict and component of every page.

    ``redirects`` (from_url, to_url) adds observed redirects to the links in the pages;
    its urls count as aliases with the rules that fit them.
    """
    judged = judged_by_rules(pages, rules).withColumn("node", node_of(F.col("url")))
    edges = page_links(pages)
    if redirects is not None:
        edges = edges.unionByName(
            redirects.select(node_of(F.col("from_url")).alias("from_node"), node_of(F.col("to_url")).alias("to_node"))
        )
    linked = components(materialize(edges, "links"), "from_node", "to_node")
    # A node is a host, a path and a query: its rule follows from itself.
    as_url = F.concat(F.lit("x://"), F.col("node"))
    verdicts = (
        with_rules(linked.withColumns({"host": host_of(as_url), "path": path_of(as_url)}), rules)
        .groupBy("component")
        .agg(F.max((F.col("own_verdict") == "allow").cast("int")).alias("allowed"), F.max((F.col("own_verdict") == "block").cast("int")).alias("blocked"))
        .select(
            F.col("component").alias("group"),
            F.when(F.col("allowed") == 1, "allow").when(F.col("blocked") == 1, "block").alias("shared"),
        )
    )
    reached = linked.join(verdicts, F.col("component") == F.col("group")).select(
        F.col("node").alias("alias"), "component", "shared"
    )
    # A node without links is a component of its own; it is spelled otherwise than the url only
    # where the path is empty or has dots.
    node_url = F.concat(F.lit("x://"), F.col("node"))
    spelled = judged.withColumns({"url_rule": F.col("rule"), "url_verdict": F.col("own_verdict"), "url_path": F.col("path")})
    spelled = with_rules(spelled.drop("rule", "own_verdict").withColumn("path", F.coalesce(path_of(node_url), F.lit(""))), rules)
    return spelled.join(reached, F.col("node") == F.col("alias"), "left").select(
        "page_id", "url", "host", F.col("url_path").alias("path"), F.col("url_rule").alias("rule"),
        F.coalesce("url_verdict", F.when(F.col("alias").isNull(), F.col("own_verdict")).otherwise(F.col("shared")), F.lit("allow")).alias("verdict"),
        F.coalesce("component", "node").alias("component"),
    )


def keep_allowed(pages: DataFrame, **options) -> DataFrame:
    """The pages whose verdict is allow; same columns. page_id must name a page."""
    blocked = filter_urls(pages, **options).filter("verdict = 'block'").select(F.col("page_id").alias("blocked_id"))
    return pages.join(blocked, F.col("page_id") == F.col("blocked_id"), "left_anti")

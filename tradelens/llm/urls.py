"""URL filters: rules on hosts and paths, and a path-template tree for the rest.

Paths are cut into segments, and segments of the usual variable forms (numbers,
hexadecimal ids, dates) become typed wildcards at once. Per host the remaining
shapes form a tree. Level by level, children of a node with many rare values
become one wildcard; then, from the deepest level up, sibling branches whose
labelled shares do not differ significantly are merged into a wildcard. What is
left are templates; one is rejected if its share of blocked labels, smoothed
towards its host's and that towards the whole table's, reaches a half.

All steps are aggregations over shapes, and the hottest host is summed up before
it is shuffled. Trees are as deep as labels differ, and ``DEPTH`` levels at least:
below the deepest node with both labels the rest of a path is one wildcard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: (verdict, host and path): a rule fits its host and all subdomains where the path starts with its path.
RULES = [
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
]
DEPTH = 6
#: A node's values are variable if it has so many, this part of its pages or more.
MANY = 12
VARIETY = 0.2
#: Values with this part of a node's pages or more stay as they are.
HEAVY = 0.2
#: Branches differ if their labelled share is so many standard errors from their siblings'.
Z = 2.58
SMOOTHING = 4.0
REJECT = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and where there is no ``://``."""
    has = F.coalesce(F.contains(url, F.lit("://")), F.lit(False))
    rest = F.element_at(F.split(url, "://", 2), 2)
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), _UPPER, _LOWER)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.when(has, host).otherwise(""), F.when(has, path).otherwise("")


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, or nulls. The rules are a short list of the caller's."""
    fits, verdicts = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        at, sep, start = rule.partition("/")
        inside = ((host == at) | F.endswith(host, F.lit("." + at))) & F.startswith(path, F.lit(sep + start))
        fits = F.when(inside, F.lit(rule)).otherwise(fits)
        verdicts = F.when(inside, F.lit(verdict)).otherwise(verdicts)
    return fits, verdicts


def _typed(segment: Column) -> Column:
    """Segments of a variable form as a typed wildcard."""
    return (
        F.when(segment.rlike("^[0-9]+$"), "{n}")
        .when(segment.rlike(r"^[0-9]+\.[A-Za-z]{1,5}$"), F.concat(F.lit("{n}."), F.substring_index(segment, ".", -1)))
        .when(segment.rlike("^[0-9]{4}-[0-9]{2}(-[0-9]{2})?$"), "{date}")
        .when(segment.rlike("^[0-9a-f-]{8,}$") & segment.rlike("[0-9]"), "{id}")
        .otherwise(segment)
    )


def _segments(path: Column) -> Column:
    """All segments, typed."""
    return F.transform(F.filter(F.split(path, "/"), lambda s: s != ""), _typed)


def _cut(segments: Column, depth: int) -> Column:
    """The first ``depth`` segments, and what is left as one wildcard."""
    return F.when(F.size(segments) > depth, F.concat(F.slice(segments, 1, depth), F.array(F.lit("**")))).otherwise(segments)


def tree_depth(pages: DataFrame) -> int:
    """The level, ``DEPTH`` at least, below which no node of (host, segments, label) rows holds both labels."""
    depth, below = DEPTH, pages.where("label IS NOT NULL")
    while True:
        node = [F.col("host"), F.slice("segments", 1, depth).alias("node")]
        below = below.where(F.size("segments") > depth)
        mixed = below.groupBy(*node).agg(F.min("label").alias("least"), F.max("label").alias("most")).where("least < most")
        mixed = written(mixed.select("host", "node"), "mixed")
        if mixed.isEmpty():
            return depth
        below = written(below.join(mixed, (below.host == mixed.host) & (F.slice(below.segments, 1, depth) == mixed.node), "left_semi"), "below")
        depth += 1


def _generalised(shapes: DataFrame, level: int) -> DataFrame:
    """Rare values of nodes with many become ``*`` at this level (1 on) of column tree."""
    node, value = F.slice("tree", 1, level - 1), F.element_at(F.col("tree"), level)
    here = shapes.where(F.size("tree") >= level).groupBy("host", node.alias("node"), value.alias("value"))
    kids = here.agg(F.sum("n").alias("n"))
    nodes = kids.groupBy("host", "node").agg(F.count(F.lit(1)).alias("kids"), F.sum("n").alias("total"))
    nodes = nodes.where((F.col("kids") >= MANY) & (F.col("kids") >= VARIETY * F.col("total")))
    rare = kids.join(nodes, ["host", "node"]).where(F.col("n") < HEAVY * F.col("total")).select("host", "node", "value")
    return _with_star(shapes, rare, level)


def _with_star(shapes: DataFrame, chosen: DataFrame, level: int, key: str = "node") -> DataFrame:
    """``*`` at ``level`` of the trees whose (host, node, value) is chosen; ``node`` is what lies around it."""
    around = {"node": F.slice("tree", 1, level - 1), "others": _starred(level)}[key]
    keyed = shapes.withColumn("_node", around).withColumn("_value", F.get("tree", F.lit(level - 1)))
    chosen = chosen.select(F.col("host").alias("_h"), F.col(key).alias("_n"), F.col("value").alias("_v"), F.lit(True).alias("_on"))
    on = (F.col("host") == F.col("_h")) & (F.col("_node") == F.col("_n")) & (F.col("_value") == F.col("_v"))
    out = keyed.join(chosen, on, "left").withColumn("tree", F.when(F.col("_on"), _starred(level)).otherwise(F.col("tree")))
    return out.select(*shapes.columns)


def _starred(level: int) -> Column:
    return F.transform(F.col("tree"), lambda s, i: F.when(i == level - 1, F.lit("*")).otherwise(s))


def _merged(shapes: DataFrame, level: int) -> DataFrame:
    """Siblings at this level whose labelled shares agree become one branch."""
    here = shapes.where((F.size("tree") >= level) & (F.element_at(F.col("tree"), level) != "*"))
    branch = here.groupBy("host", _starred(level).alias("others"), F.element_at(F.col("tree"), level).alias("value")).agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")
    )
    group = branch.groupBy("host", "others").agg(
        F.sum("labelled").alias("all_labelled"), F.sum("blocked").alias("all_blocked"), F.count(F.lit(1)).alias("kids")
    )
    pooled = (F.col("all_blocked") + 0.5) / (F.col("all_labelled") + 1.0)
    off = F.abs(F.col("blocked") - F.col("labelled") * pooled)
    alike = branch.join(group.where("kids > 1"), ["host", "others"]).where(
        off <= Z * F.sqrt(F.col("labelled") * pooled * (1 - pooled))
    )
    return _with_star(shapes, alike.select("host", "others", "value"), level, "others")


def templates(pages: DataFrame) -> DataFrame:
    """(host, shape, template, purity) from rows of host, shape, label (1 blocked, 0 allowed, null).

    ``purity`` is the smoothed share of blocked labels.
    """
    shapes = pages.groupBy("host", "shape").agg(
        F.count(F.lit(1)).alias("n"), F.count("label").alias("labelled"), F.coalesce(F.sum("label"), F.lit(0)).alias("blocked")
    )
    shapes = written(shapes.withColumn("tree", F.col("shape")), "shapes")
    deepest = shapes.agg(F.max(F.size("tree"))).first()[0] or 0
    for level in range(1, deepest + 1):
        shapes = written(_generalised(shapes, level), "shapes")
    for level in range(deepest, 0, -1):
        shapes = written(_merged(shapes, level), "shapes")

    sums = [F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")]
    every = shapes.agg(*sums).first()
    whole = ((every["blocked"] or 0) + 0.5) / ((every["labelled"] or 0) + 1.0)
    share = lambda prior: (F.col("blocked") + SMOOTHING * prior) / (F.col("labelled") + SMOOTHING)
    hosts = shapes.groupBy("host").agg(*sums).select("host", share(F.lit(whole)).alias("host_share"))
    trees = shapes.groupBy("host", "tree").agg(*sums).join(hosts, "host")
    trees = trees.select("host", "tree", share(F.col("host_share")).alias("purity"))
    named = shapes.join(trees, ["host", "tree"])
    return written(named.select("host", "shape", F.concat(F.lit("/"), F.array_join("tree", "/")).alias("template"), "purity"), "templates")


def judge_urls(
    pages: DataFrame, id: str = "page_id", url: str = "url", rules: list[tuple[str, str]] | None = None, label: str | None = None
) -> DataFrame:
    """One row per row: ``id``, host, path, rule, verdict, template, purity.

    The verdict is the longest fitting rule's, else that of the url's template:
    block if its purity (share of blocked labels, smoothed) is ``REJECT`` or
    more. Labels are the rules' verdicts and, where a column ``label`` (1 block,
    0 allow) is named and not null, that instead. Null urls and urls without
    ``://`` have an empty host and path, and the empty host's template. Repeated
    rows are judged each; an empty table gives an empty result.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(
        F.col(id).alias("id"), host.alias("host"), path.alias("path"), (F.col(label) if label else F.lit(None)).cast("int").alias("given")
    )
    fits, verdict = rule_of(F.col("host"), F.col("path"), RULES if rules is None else rules)
    rows = rows.select("*", fits.alias("rule"), verdict.alias("ruled"), _segments(F.col("path")).alias("segments"))
    labels = F.coalesce("given", F.when(F.col("ruled") == "block", 1).when(F.col("ruled") == "allow", 0))
    depth = tree_depth(rows.select("host", "segments", labels.alias("label")))
    rows = rows.withColumn("shape", _cut(F.col("segments"), depth)).drop("segments")
    known = templates(rows.select("host", "shape", labels.alias("label")))
    out = rows.join(known, ["host", "shape"])
    method = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return out.select(
        F.col("id").alias(id), "host", "path", "rule", F.coalesce("ruled", method).alias("verdict"), "template", "purity"
    )

"""URL filters: rules first, then a tree of path templates for each host.

A url's path is cut into segments. Numbers, hex strings, dates and tokens become typed wildcards at
once. The tree of a host is then built level by level. At each node its children, summed over all
that lies below them, turn into branches, and the next level groups by branches, so what lies below
a wildcard is pooled:

* a typed wildcard stays what it is;
* a child with ``MIN_LABELS`` and more labels is compared with all other such children of its node by
  a two-proportion test, whose threshold grows with their number. If it is apart, it stays as it
  is, whatever its share; those that are alike are merged, named after the least of them and
  how many there are besides;
* of the others, children of a variable segment, and rare ones anywhere, become ``*``; a
  segment is variable if more than ``SECTIONS`` children of it are not rare. In all other nodes they
  stay as they are. So labels never speak for a section without labels of its own.

What a url's segments turn into is its template. A template is rejected if its share of bad urls
among its labelled ones, smoothed towards that of the whole, reaches ``REJECT``, and the
lower confidence bound of the share itself reaches ``LEAST``. Without labels of its own it is never
rejected. Labels are the verdicts of the rules, and more can be given.

Urls are summed to shapes (host and typed path) before anything else, so a host that holds a
third of all urls is a few rows for each of its shapes. Nodes are sums over those; nothing is
gathered or sorted for a node, however many children it has.

Defined cases: a null url, or one without ``://``, has an empty host and path, and the verdict of
the template of those. Repeated urls count as often as they are there. Segments past ``MAX_DEPTH``
are one ``**``; a very long segment is one like any other. Empty tables give no rows. Other columns
are not read, whatever they are called.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchloom.llm.texts import ascii_lower, named, whole
from searchloom.sinks.tables import staged

MAX_DEPTH = 8
#: urls of a child that is not rare, and how many such children a segment that is not variable may have
MIN_CHILD, SECTIONS = 3, 20
MIN_LABELS = 5
#: standard deviations apart for two children; more by chance among many
APART_Z = 2.0
PRIOR_WEIGHT, REJECT = 4.0, 0.8
#: lower bound of a rejected template's share, at so many standard deviations
LEAST, BOUND_Z = 0.7, 1.645

#: (pattern of a whole segment, what stands for it), tried in this order
TYPED = [
    (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}", "{date}"),
    (r"^[0-9]+(?=$|\.)", "{number}"),
    (r"^[0-9a-fA-F]*[0-9][0-9a-fA-F]{7,}(?=$|\.)", "{hex}"),
    (r"^(?=[^.]*[0-9])[0-9A-Za-z_-]{12,}(?=$|\.)", "{token}"),
]


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(rules: list[tuple[str, str]], host: Column, path: Column) -> Column:
    """(rule, verdict) of the longest rule that fits, else null. A rule is ``host/path``; of two equal ones a block wins."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[0] == "block", r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{rest}")
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def _typed(segment: Column) -> Column:
    out = segment
    for pattern, name in reversed(TYPED):
        out = F.when(segment.rlike(pattern), F.regexp_replace(segment, pattern, name.replace("{", "\\{"))).otherwise(out)
    return out


def shape_of(path: Column) -> Column:
    """The typed segments of a path, joined by slashes."""
    segments = F.split(path, "/")
    head = F.transform(F.slice(segments, 1, MAX_DEPTH), _typed)
    return F.array_join(F.when(F.size(segments) > MAX_DEPTH, F.concat(head, F.array(F.lit("**")))).otherwise(head), "/")


def parsed(pages: DataFrame, keep: list[Column], url_col: str, rules: list[tuple[str, str]]) -> DataFrame:
    """(keep, host, path, shape, found)."""
    url = named(url_col)
    rows = pages.select(*keep, host_of(url).alias("host"), path_of(url).alias("path"))
    return rows.withColumn("shape", shape_of(F.col("path"))).withColumn("found", rule_of(rules, F.col("host"), F.col("path")))


def _smoothed(bad: str, labelled: str, prior: Column) -> Column:
    return (F.col(bad) + prior * PRIOR_WEIGHT) / (F.col(labelled) + PRIOR_WEIGHT)


def _lower(bad: str, labelled: str) -> Column:
    """Lower bound of the share of bad ones (Wilson's score interval); 0 without labels."""
    n, z = F.col(labelled).cast("double"), BOUND_Z
    p = F.col(bad) / n
    return F.when(n > 0, (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)).otherwise(0.0)


def steps(children: DataFrame) -> DataFrame:
    """(host, prefix, child, step): what each child (host, prefix, child, n, bad, labelled) of each node turns into."""
    node = ["host", "prefix"]
    typed = F.col("child").rlike(r"^(\{|\*\*)")
    tested = ~typed & (F.col("labelled") >= MIN_LABELS)
    children = children.withColumn("tested", tested)
    sums = children.groupBy(*node).agg(
        F.count_if(~typed & (F.col("n") >= MIN_CHILD)).alias("sections"), F.count_if("tested").alias("m"),
        F.sum(F.when(F.col("tested"), F.col("bad")).otherwise(0)).alias("all_bad"), F.sum(F.when(F.col("tested"), F.col("labelled")).otherwise(0)).alias("all_labelled"),
    )
    rest_bad, rest = F.col("all_bad") - F.col("bad"), F.col("all_labelled") - F.col("labelled")
    pooled = F.col("all_bad") / F.col("all_labelled")
    spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / rest))
    apart = F.when(rest > 0, F.abs(F.col("bad") / F.col("labelled") - rest_bad / rest) > spread * (F.sqrt(2 * F.log(F.col("m").cast("double"))) + APART_Z)).otherwise(False)
    judged_ = children.join(sums, node).select(*node, "child", "n", "tested", "sections", F.when(F.col("tested"), apart).alias("apart"))
    alike = judged_.where("tested AND NOT apart").groupBy(*node).agg(F.min("child").alias("first"), F.count("*").alias("members"))
    found = judged_.join(alike, node, "left")
    merged = F.when(F.col("members") > 1, F.concat("first", F.lit("|+"), (F.col("members") - 1).cast("string"))).otherwise(F.col("child"))
    variable = (F.col("n") < MIN_CHILD) | (F.col("sections") > SECTIONS)
    step = F.when(typed, F.col("child")).when(F.col("tested"), F.when(F.col("apart"), F.col("child")).otherwise(merged)).when(variable, F.lit("*")).otherwise(F.col("child"))
    return found.select(*node, "child", step.alias("step"))


def templates(rows: DataFrame) -> DataFrame:
    """(host, shape, template, purity, lower) from rows with host, shape and bad (1, 0, or null without a label)."""
    shapes = staged(rows.groupBy("host", "shape").agg(F.count("*").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.count("bad").alias("labelled")), "url-shapes")
    whole_ = shapes.agg(F.sum("bad"), F.sum("labelled")).first()
    base = F.lit((whole_[0] or 0) / whole_[1] if whole_[1] else 0.0)
    open_ = shapes.withColumn("prefix", F.lit(""))
    done = []
    for depth in range(MAX_DEPTH + 1):
        level = open_.withColumn("child", F.get(F.split("shape", "/"), F.lit(depth)))
        children = level.groupBy("host", "prefix", "child").agg(*[F.sum(c).alias(c) for c in ("n", "bad", "labelled")])
        named_ = level.join(steps(children), ["host", "prefix", "child"])
        ends = F.size(F.split("shape", "/")) == depth + 1
        prefix = F.col("step") if depth == 0 else F.concat("prefix", F.lit("/"), "step")
        level = staged(named_.select(*shapes.columns, prefix.alias("prefix"), ends.alias("ends")), "url-level")
        done.append(level.where("ends").drop("ends"))
        open_ = level.where("NOT ends").drop("ends")
        if open_.isEmpty():
            break
    found = functools.reduce(DataFrame.unionByName, done).withColumnRenamed("prefix", "template")
    sums = found.groupBy("host", "template").agg(F.sum("bad").alias("bad"), F.sum("labelled").alias("labelled"))
    sums = sums.select("host", "template", _smoothed("bad", "labelled", base).alias("purity"), _lower("bad", "labelled").alias("lower"))
    return found.select("host", "shape", "template").join(sums, ["host", "template"])


def judged(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url", labels: DataFrame | None = None) -> DataFrame:
    """Per row: id, ``host``, ``path``, ``rule``, ``verdict``, ``template``, ``purity`` (smoothed bad share of the template, 6 decimals).

    ``labels`` may hold (id, bad) with bad 1 or 0, one row for an id; rules come first.
    """
    rows = parsed(pages, [named(id_col).alias("_id")], url_col, rules)
    ruled = F.when(F.col("found.verdict") == "block", 1).when(F.col("found.verdict") == "allow", 0)
    known = rows
    if labels is not None:
        known = rows.join(labels.select(named(id_col).alias("_id"), F.col("bad").cast("int").alias("given")), "_id", "left")
        ruled = F.coalesce(ruled, "given")
    found = staged(templates(known.select("host", "shape", ruled.alias("bad"))), "url-judged")
    method = F.when((F.col("purity") >= REJECT) & (F.col("lower") >= LEAST), "block").otherwise("allow")
    return rows.join(found, ["host", "shape"], "left").select(
        F.col("_id").alias(id_col), "host", "path", F.col("found.rule").alias("rule"), F.coalesce("found.verdict", method).alias("verdict"), "template", F.round("purity", 6).alias("purity")
    )

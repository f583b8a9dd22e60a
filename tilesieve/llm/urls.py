"""URL verdicts by a path-template tree, with built-in functions only.

Rules name a host suffix and a path prefix; the longest that fits an URL decides it.  All other
URLs are judged by templates learned from the URLs that rules decide.

The tree of a host is built level by level.  Under a branch, a segment stays literal if its share of
blocked URLs differs significantly from that of its wildcard, which holds all segments that do not;
a segment without labels, or whose wildcard has none, stays literal if it is frequent.  How many
other segments a branch has plays no part.  A branch is split as deep as its paths go, unless none
of its URLs is labelled or all have one path.  Hosts without any labelled URL
use the tree of all hosts (host ``*``), which is built in the same way.  Each template has a purity, the share of
its labelled URLs that are blocked, smoothed towards that of its parent; an URL is blocked if the
purity of its longest labelled template is above ``reject``.

Only counts per branch are gathered; a hot host is added up in the tasks.  Null URLs and those
without ``://`` have an empty host and path and are allowed, unless labelled templates of the empty
path say otherwise.  Repeated rows count as often as they come.  Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written

# A segment without labels stays literal if it has at least this many URLs.
LEAST_ROWS = 8
# Normal deviate below which two shares count as alike; pseudo-observations of the parent; verdict.
ALIKE, SMOOTH, REJECT = 2.0, 2.0, 0.5

# The tree of all hosts and the wildcard of a template inside the tables: no host holds a slash, and no
# segment is empty.
ALL_HOSTS, WILDCARD = "/", ""

Rule = tuple[str, str, str]  # verdict, host, path prefix


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of an URL, both empty without ``://``."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(host, upper, lower), path


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The text (host and path) and the verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, at, prefix in sorted(rules, key=lambda r: len(r[1]) + len(r[2])):  # longer ones come later and win
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(prefix)
        name, verdict = F.when(fits, F.lit(at + prefix)).otherwise(name), F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def _segments(path: Column) -> Column:
    """The segments of a path, without empty ones; a file's ending is part of its segment."""
    return F.filter(F.split(path, "/"), lambda s: s != "")


def _apart(labelled: Column, blocked: Column, others: Column, others_blocked: Column) -> Column:
    """Whether two shares of blocked URLs differ significantly (with continuity correction); null without labels on either side."""
    pooled = (blocked + others_blocked) / (labelled + others)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / labelled + 1 / others))
    difference = F.abs(blocked / labelled - others_blocked / others) - (1 / labelled + 1 / others) / 2
    return F.when((labelled > 0) & (others > 0), difference > ALIKE * spread)


def _level(counts: DataFrame) -> DataFrame:
    """The literals (host, template, segment) of each branch; ``counts`` has one row per segment."""
    branch = counts.groupBy("host", "template").agg(F.sum("labelled").alias("_l"), F.sum("blocked").alias("_b"))
    own, blocked = F.col("labelled"), F.col("blocked")
    # At first the comparison is with all other segments of the branch, then with those that are left for the wildcard.
    first = F.coalesce(_apart(own, blocked, F.col("_l") - own, F.col("_b") - blocked), F.lit(False))
    tested = counts.join(branch, ["host", "template"]).withColumn("_first", first)
    in_wildcard = F.when(~F.col("_first"), 1).otherwise(0)
    wild = tested.groupBy("host", "template").agg(F.sum(own * in_wildcard).alias("_wl"), F.sum(blocked * in_wildcard).alias("_wb"))
    second = _apart(own, blocked, F.col("_wl") - own * in_wildcard, F.col("_wb") - blocked * in_wildcard)
    kept = F.coalesce(second, F.col("_first") | (F.col("n") >= LEAST_ROWS))
    return tested.join(wild, ["host", "template"]).filter(kept).select("host", "template", "segment")


def tree(urls: DataFrame, depth: int | None = None) -> tuple[DataFrame, DataFrame, int]:
    """(host, segments, template, level) of every shape, (host, template, level, labelled, blocked) of every template, deepest level.

    ``urls`` has (host, segments, labelled, blocked), counts of URLs of that shape in ``n``.  Shapes
    have a row per level, as far as their branches are split, in the tree of their host and in that of all hosts.
    """
    everywhere = urls.withColumn("host", F.lit(ALL_HOSTS))
    rows = urls.unionByName(everywhere).withColumn("template", F.lit(""))
    rows = rows.groupBy("host", "segments", "template").agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "blocked")))
    rows = written(rows, "branches0")
    steps, sums, level = None, None, 0
    while True:
        step = rows.select("host", "segments", "template").withColumn("level", F.lit(level))
        total = rows.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")).withColumn("level", F.lit(level))
        steps, sums = (step, total) if steps is None else (steps.unionByName(step), sums.unionByName(total))
        there = rows.filter(F.size("segments") > level).withColumn("segment", F.get("segments", F.lit(level)))
        # A branch without labels, or of one path only, cannot be split.
        split = rows.groupBy("host", "template").agg(F.sum("labelled").alias("_l"), F.count(F.lit(1)).alias("_n"))
        there = there.join(split.filter("_l > 0 and _n > 1").select("host", "template"), ["host", "template"], "left_semi")
        if level == depth or there.isEmpty():
            return steps, sums, level
        counts = there.groupBy("host", "template", "segment").agg(*(F.sum(c).alias(c) for c in ("n", "labelled", "blocked")))
        level += 1
        rows = written(_descend(there, written(_level(counts), f"literals{level}")), f"branches{level}")


def _descend(rows: DataFrame, kept: DataFrame) -> DataFrame:
    """One level down: the template grows by the segment if it is kept, else by the wildcard."""
    marked = rows.join(kept.withColumn("_kept", F.lit(True)), ["host", "template", "segment"], "left")
    step = F.when(F.col("_kept"), F.col("segment")).otherwise(WILDCARD)
    return marked.withColumn("template", F.concat("template", F.lit("/"), step)).drop("_kept", "segment")


def shown(template: Column) -> Column:
    """A template with ``*`` for its wildcards; a segment ``*`` of the URLs themselves is ``%2A``."""
    literal = F.regexp_replace(template, r"(?<=/)\*(?=/|\z)", "%2A")
    return F.regexp_replace(literal, r"(?<=/)(?=/|\z)", "*")


def purities(templates: DataFrame, deepest: int) -> DataFrame:
    """(host, template, purity) of the templates with labels, smoothed towards their parents."""
    labelled = written(templates.filter("labelled > 0"), "labelled")
    parent = F.regexp_replace("template", "/[^/]*$", "")
    smoothed = lambda p: (F.col("blocked") + SMOOTH * p) / (F.col("labelled") + SMOOTH)
    current = labelled.filter("level = 0").select("host", "template", smoothed(F.lit(0.0)).alias("purity"))
    found = current
    for level in range(1, deepest + 1):
        here = labelled.filter(F.col("level") == level).withColumn("_parent", parent)
        above = current.select("host", F.col("template").alias("_parent"), F.col("purity").alias("_p"))
        current = written(here.join(above, ["host", "_parent"]).select("host", "template", smoothed(F.col("_p")).alias("purity")), f"purities{level}")
        found = found.unionByName(current)
    return found


def judge(pages: DataFrame, rules: Sequence[Rule], depth: int | None = None, reject: float = REJECT, id_col: str = "page_id", url: str = "url") -> DataFrame:
    """(id, host, path, rule, template, purity, verdict) of every row.

    ``template`` and ``purity`` are those that decide an URL without rule, null where nothing is known.
    Paths are judged by all their segments, or by the first ``depth`` of them if that is given.
    """
    host, path = split_url(F.col(url))
    split = pages.select(F.col(id_col).alias(id_col), host.alias("host"), path.alias("path"))
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    ruled = split.withColumns({"rule": name, "_verdict": verdict, "segments": _segments(F.col("path"))})
    counted = ruled.groupBy("host", "segments").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("_verdict").alias("labelled"),
        F.coalesce(F.sum((F.col("_verdict") == "block").cast("bigint")), F.lit(0)).alias("blocked"),
    )
    shapes = written(counted, "shapes")
    steps, templates, deepest = tree(shapes, depth)
    purity = written(purities(templates, deepest), "purities")
    # Every shape's longest labelled template in its host's tree and in that of all hosts.
    known = steps.join(purity, ["host", "template"])
    longest = written(known.groupBy("host", "segments").agg(F.max_by(F.struct("template", "purity"), "level").alias("_best")), "longest")
    own = shapes.select("host", "segments").join(longest, ["host", "segments"], "left")
    everywhere = longest.filter(F.col("host") == ALL_HOSTS).select("segments", F.col("_best").alias("_else"))
    # The own host's wins over that of all hosts.
    other = own.filter("_best is null").join(everywhere, "segments").select("host", "segments", F.col("_else").alias("_best"))
    best = own.filter("_best is not null").unionByName(other)
    decided = ruled.join(best, ["host", "segments"], "left")
    learned = F.when(F.col("_best.purity") > reject, "block").otherwise("allow")
    return decided.select(
        id_col,
        "host",
        "path",
        "rule",
        F.when(F.col("rule").isNull(), shown(F.col("_best.template"))).alias("template"),
        F.when(F.col("rule").isNull(), F.col("_best.purity")).alias("purity"),
        F.coalesce("_verdict", learned).alias("verdict"),
    )

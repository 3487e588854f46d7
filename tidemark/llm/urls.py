"""URL filters: rules on hosts and paths, and a tree of path templates learnt for each host.

Segments of a path that vary become wildcards, level by level; sibling templates whose labelled purity can't be
told apart become one, as do those without labels whose number of pages can't be told apart from their labelled
siblings'; a template is rejected if the smoothed share of bad pages among its labelled ones is high. So what is
known of some branches reaches those beside them. Labels are the verdicts of the rules, or a table of (page_id, bad).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, quoted, without
from tidemark.session import stage

#: Fixed values: (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)

#: Levels of the tree that are built before it is staged; those of the SQL, which knows no deeper ones.
LEVELS = 4
#: Tasks that the paths of one place are dealt to where they are joined with what is known of it.
SLOTS = 32
#: A segment varies if it is a number (with an ending), or if its place holds at least so many pages
#: and so large a share of different segments.
NUMBER = r"^[0-9]+([.][A-Za-z0-9]+)?$"
LEAST_PAGES, LEAST_SHARE = 20, 0.5
#: Siblings are alike if their purity is within so many standard errors of what they have together.
ERRORS = 1.96
#: Labelled pages that the overall purity counts for, and the smoothed purity that is rejected.
PRIOR, REJECT = 4.0, 0.5


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), "^[^/?#]*", 0)), F.lit(""))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule as text, its verdict) of the longest rule that fits, or nulls."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for domain, start, says in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(start)
        found = F.when(fits, F.lit(domain + start)).otherwise(found)
        verdict = F.when(fits, F.lit(says)).otherwise(verdict)
    return found, verdict


def _next_level(tree: DataFrame, level: int) -> DataFrame:
    """``tree`` with the segment of one more level, or a wildcard, at the end of its templates."""
    tree = tree.withColumn("segment", F.get("segments", F.lit(level)))
    children = tree.where(F.col("segment").isNotNull()).groupBy("host", "template", "segment")
    children = children.agg(F.sum("pages").alias("pages"))
    places = children.groupBy("host", "template").agg(
        F.sum("pages").alias("all_pages"), F.count(F.lit(1)).alias("different")
    )
    varied = places.where(
        (F.col("all_pages") >= LEAST_PAGES) & (F.col("different") >= LEAST_SHARE * F.col("all_pages"))
    ).select("host", "template", F.lit(True).alias("varied"))
    # at the first level the template is empty, so a host's paths are dealt to slots
    varied = varied.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    slot = F.pmod(F.xxhash64("path"), F.lit(SLOTS)).cast("int")
    joined = tree.withColumn("slot", slot).join(varied, ["host", "template", "slot"], "left")
    wild = F.coalesce("varied", F.lit(False)) | F.col("segment").rlike(NUMBER)
    name = F.when(wild, F.lit("*")).otherwise(F.col("segment"))
    longer = F.when(F.col("segment").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), name))
    return joined.select("host", "path", "pages", "known", "bad", "segments", longer.alias("template"))


def _tree(nodes: DataFrame) -> DataFrame:
    """``nodes`` with the template of each path, level by level until no place can vary any more.

    A place with fewer than ``LEAST_PAGES`` pages can't, nor can any below it, so what is left of such paths
    follows at once and the number of levels isn't that of the deepest path, but of the deepest place with so many pages.
    """
    parts = F.filter(F.split("path", "/", -1), lambda s: s != "")
    tree = nodes.withColumns({"segments": parts, "template": F.lit("")})
    done, level = [], 0
    while True:
        for _ in range(LEVELS):
            tree = _next_level(tree, level)
            level += 1
        tree = stage(tree, "url-templates")
        deeper = F.size("segments") > level
        places = tree.where(deeper).groupBy("host", "template").agg(F.sum("pages").alias("all_pages"))
        places = places.where(F.col("all_pages") >= LEAST_PAGES).select("host", "template", F.lit(True).alias("large"))
        rest = F.transform(
            F.slice("segments", level + 1, F.greatest(F.size("segments"), F.lit(0))),
            lambda s: F.concat(F.lit("/"), F.when(s.rlike(NUMBER), F.lit("*")).otherwise(s)),
        )
        whole = F.concat("template", F.array_join(rest, ""))
        columns = ["host", "path", "pages", "known", "bad", whole.alias("template")]
        if places.isEmpty():
            done.append(tree.select(*columns))
            return reduce(DataFrame.unionByName, done)
        marked = stage(tree.join(places, ["host", "template"], "left"), "url-places")
        open_ = deeper & F.coalesce("large", F.lit(False))
        done.append(marked.where(~open_).select(*columns))
        tree = marked.where(open_).drop("large")


def templates(pages: DataFrame) -> DataFrame:
    """host, path, template, merged, purity, rejected for each distinct host and path.

    ``pages`` has host, path and bad (true, false or null: without a label). Counts are combined before
    every shuffle, so a host that holds a third of all pages is never in one task.
    """
    nodes = pages.groupBy("host", "path").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count("bad").alias("known"),
        F.sum(F.coalesce(F.col("bad").cast("long"), F.lit(0))).alias("bad"),
    )
    tree = _tree(nodes)
    # siblings differ in their last literal segment only; {} stands for it
    sibling = F.regexp_replace("template", r"[^/*{}]+((/[*]+)*)$", r"{}$1")
    branches = tree.groupBy("host", "template").agg(
        F.sum("pages").alias("pages"),
        F.sum("known").alias("known"),
        F.sum("bad").alias("bad"),
        F.max(sibling).alias("sibling"),
    )
    branches = stage(branches, "url-branches")
    together = branches.groupBy("host", "sibling").agg(
        F.sum("known").alias("all_known"),
        F.sum("bad").alias("all_bad"),
        F.avg(F.when(F.col("known") > 0, F.col("pages"))).alias("usual"),
    )
    compared = branches.join(together, ["host", "sibling"])
    mean = F.col("all_bad") / F.col("all_known")
    error = F.sqrt(mean * (1 - mean) * (1 / F.col("known") - 1 / F.col("all_known")))
    alike = F.abs(F.col("bad") / F.col("known") - mean) <= ERRORS * error + 1e-9
    # a branch without labels has only its shape: the same depth and wildcards, and about as many pages
    pages, usual = F.col("pages"), F.col("usual")
    same_shape = (pages - usual) * (pages - usual) <= ERRORS**2 * (pages + usual)
    joins = F.coalesce(F.when(F.col("known") > 0, alike).otherwise(same_shape), F.lit(False))
    compared = compared.withColumn("merged", F.when(joins, F.col("sibling")).otherwise(F.col("template")))
    overall = branches.agg(F.coalesce(F.sum("bad") / F.nullif(F.sum("known"), F.lit(0)), F.lit(0.0))).scalar()
    pure = compared.groupBy("host", "merged").agg(F.sum("known").alias("n"), F.sum("bad").alias("m"))
    pure = pure.withColumn("overall", overall)
    purity = (F.col("m") + PRIOR * F.col("overall")) / (F.col("n") + PRIOR)
    pure = pure.select(
        "host", "merged", purity.alias("purity"), ((F.col("n") > 0) & (purity >= REJECT)).alias("rejected")
    )
    judged = compared.select("host", "template", "merged").join(pure, ["host", "merged"])
    return tree.select("host", "path", "template").join(judged, ["host", "template"]).select(
        "host", "path", "template", "merged", "purity", "rejected"
    )


def filter_urls(
    pages: DataFrame, labels: DataFrame | None = None, rules: Sequence[tuple[str, str, str]] = RULES
) -> DataFrame:
    """``pages`` (page_id, url, ..) with host, path, rule, template, purity and verdict (allow or block).

    The longest rule that fits decides; the other pages are blocked if their template is rejected. A
    template without a labelled page, neither in it nor in those it merges with, is allowed. Null urls and urls without ``://`` have an empty host and
    path. Repeated rows are judged alike; columns with a name of those added are replaced.
    """
    added = ["host", "path", "rule", "template", "purity", "verdict"]
    kept = without(pages, added).columns
    own = pages.select(
        F.struct(*[quoted(c) for c in kept]).alias("row"),
        (F.col("page_id") if "page_id" in kept else F.lit(None)).alias("page_id"),
        host(F.col("url")).alias("host"),
        path(F.col("url")).alias("path"),
    )
    text, says = rule(F.col("host"), F.col("path"), rules)
    own = own.withColumns({"rule": text, "says": says})
    if labels is None:
        marked = own.select("host", "path", (F.col("says") == "block").alias("bad"))
    else:
        known = labels.where("page_id IS NOT NULL").groupBy("page_id").agg(F.max(F.col("bad")).alias("bad"))
        marked = own.select("page_id", "host", "path").join(known, "page_id", "left").select("host", "path", "bad")
    found = templates(marked).select("host", "path", "template", "purity", "rejected")
    verdict = F.coalesce("says", F.when(F.col("rejected"), F.lit("block")).otherwise("allow")).alias("verdict")
    out = own.join(found, ["host", "path"], "left")
    return out.select(*[F.col("row").getField(c).alias(c) for c in kept], *added[:-1], verdict)

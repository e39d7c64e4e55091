"""URL filtering by rules and by a tree of path templates (operator 8).

Rules decide what they fit. Their verdicts are also labels for the rest. Per host, paths form a tree of segments, from
which templates are grown level by level:

* numbers and long hexadecimal strings are wildcards at once;
* labelled branches whose share of blocked urls does not differ significantly from that of their labelled siblings are
  merged into ``{rated}`` (two proportions). A branch that differs keeps its name;
* a branch without labels joins ``{rated}`` if what lies below it does not differ significantly from what lies below the
  labelled ones (chi-square over the counts of the next segments), or if it is one of the rare values of a node with many
  children. The others are ``{any}``.

A template is rejected if its smoothed purity, (blocked + strength * prior) / (labelled + strength), reaches ``reject``.
The prior lies half way between one half and the smoothed blocked share of the host's other templates. So a url that no
rule fits is judged by the labels its template shares; other labels of its host lean on that, but cannot reject it alone.

Urls are counted per host and normalised path before anything else, so a host with a third of all pages is as many rows
as it has different paths; the levels join these counts only. DataFrame functions do all of it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tasteforge.llm.html import host_of
from tasteforge.session import materialize


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and its subdomains where the path begins with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


@dataclass(frozen=True)
class Tree:
    """``levels`` segments have a level of their own; deeper ones are one name, whole, at the next level.

    At a node with more than ``children`` different children those with less than ``share`` of its urls are values of a
    variable. ``least`` labelled urls make a branch labelled; ``z`` is the critical value of both comparisons.
    """

    levels: int = 4
    children: int = 24
    share: float = 0.05
    least: int = 3
    z: float = 2.58
    strength: float = 4.0
    reject: float = 0.75


def path_of(url: Column | str) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule's text, or null."""
    longest = sorted(rules, key=lambda r: (-len(r.text), r.text))
    return F.coalesce(*[F.when(r.fits(host, path), r.text) for r in longest], F.lit(None).cast("string"))


def segments_of(path: Column, cfg: Tree) -> Column:
    """Normalised segments: numbers and hexadecimal strings as wildcards; those behind ``cfg.levels`` joined as one."""
    parts = F.filter(F.split(path, "/"), lambda s: s != "")
    plain = F.transform(
        parts,
        lambda s: F.when(s.rlike(r"^(?=.*[0-9])[0-9a-fA-F-]{12,}$"), "{h}").otherwise(F.regexp_replace(s, "[0-9]+", "{n}")),
    )
    rest = F.array_join(F.slice(plain, cfg.levels + 1, F.greatest(F.size(plain), F.lit(1))), "/")
    return F.when(F.size(plain) > cfg.levels, F.concat(F.slice(plain, 1, cfg.levels), F.array(rest))).otherwise(plain)


def _sums(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", "blocked", "labelled")])


def _like_labelled(shape: DataFrame, pooled: DataFrame, cfg: Tree) -> DataFrame:
    """(host, template, segment) of the branches whose next segments come in shares like those of all ``pooled`` branches.

    Homogeneity of two rows of counts: the sum over next segments of (a/A - b/B)^2 A B / (a + b) against the chi-square
    quantile of Wilson and Hilferty. A segment that only the pooled branches have adds b A / B, so those are never joined.
    """
    pool = shape.join(pooled, ["host", "template", "segment"]).groupBy("host", "template", "next").agg(F.sum("n").alias("b"))
    pools = pool.groupBy("host", "template").agg(F.sum("b").alias("all_b"), F.count("*").alias("kinds"))
    sizes = shape.groupBy("host", "template", "segment").agg(F.sum("n").alias("all_a"))
    met = shape.join(sizes, ["host", "template", "segment"]).join(pools, ["host", "template"]).join(pool, ["host", "template", "next"], "left")
    a, b, both = F.col("n"), F.coalesce("b", F.lit(0)), F.col("all_a") * F.col("all_b")
    gap = a / F.col("all_a") - b / F.col("all_b")
    branch = met.groupBy("host", "template", "segment").agg(
        F.sum(gap * gap * both / (a + b)).alias("own"), F.sum(b).alias("shared"), F.count(F.when(b == 0, 1)).alias("new"),
        *[F.max(c).alias(c) for c in ("all_a", "all_b", "kinds")],
    )
    distance = F.col("own") + (F.col("all_b") - F.col("shared")) * F.col("all_a") / F.col("all_b")
    freedom = F.col("new") + F.col("kinds") - 1
    unit = 2 / (9 * F.greatest(freedom, F.lit(1)))
    critical = freedom * F.pow(1 - unit + cfg.z * F.sqrt(unit), 3)
    return branch.where((freedom == 0) | (distance < critical)).select("host", "template", "segment", F.lit(True).alias("alike"))


def grow(counts: DataFrame, cfg: Tree) -> DataFrame:
    """``counts`` (host, segments, n, blocked, labelled) with ``template``: the segments after wildcards and merging."""
    current = counts.withColumn("template", F.array().cast("array<string>"))
    keys = ["host", "template", "segment"]
    deepest = counts.agg(F.max(F.size("segments"))).first()[0] or 0  # never more than cfg.levels + 1
    for level in range(deepest):
        at = lambda i: F.coalesce(F.get("segments", F.lit(i)), F.lit(""))  # noqa: E731 - empty: the path has ended
        placed = current.withColumn("segment", at(level)).withColumn("next", at(level + 1))
        shape = materialize(_sums(placed.where("segment <> ''"), *keys, "next"), "shape")
        kids = _sums(shape, *keys)
        known = F.col("labelled") >= cfg.least
        parents = kids.groupBy("host", "template").agg(
            F.count("*").alias("kids"), F.sum("n").alias("total"),
            F.sum(F.when(known, F.col("blocked"))).alias("all_blocked"), F.sum(F.when(known, F.col("labelled"))).alias("all_labelled"),
        )
        rest = F.col("all_labelled") - F.col("labelled")
        other = (F.col("all_blocked") - F.col("blocked")) / rest
        pooled = F.col("all_blocked") / F.col("all_labelled")
        spread = F.sqrt(pooled * (1 - pooled) * (1 / F.col("labelled") + 1 / rest))
        differs = (rest > 0) & (spread > 0) & (F.abs(F.col("blocked") / F.col("labelled") - other) >= cfg.z * spread)
        rare = (F.col("kids") > cfg.children) & (F.col("n") < cfg.share * F.col("total"))
        state = F.when(known, F.when(differs, "own").otherwise("pooled")).when(rare, "rare").otherwise("unknown")
        seen = materialize(kids.join(parents, ["host", "template"]).select(*keys, state.alias("state")), "branches")
        alike = _like_labelled(shape, seen.where("state = 'pooled'").select(*keys), cfg)
        name = (
            F.when(F.col("state") == "own", F.col("segment"))
            .when(F.col("state").isin("pooled", "rare") | F.col("alike"), "{rated}")
            .otherwise("{any}")
        )
        names = seen.join(alike, keys, "left").select(*keys, name.alias("name"))
        joined = placed.join(names, keys, "left")  # ended paths have no name
        grown = F.when(F.col("name").isNull(), F.col("template")).otherwise(F.concat("template", F.array("name")))
        current = materialize(joined.select("host", "segments", "n", "blocked", "labelled", grown.alias("template")), "tree")
    return current


def judge_urls(pages: DataFrame, rules: list[Rule], cfg: Tree = Tree(), page_id: str = "page_id", url: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity) for every row.

    verdict is ``allow`` or ``block``: the longest fitting rule's, else ``block`` where the template is rejected. A null
    url, or one without ``://``, has an empty host and path and is judged like any other path of that empty host. Rows are
    kept as they are, repeated ones too; other columns are ignored.
    """
    address = F.coalesce(F.col(f"`{url}`").cast("string"), F.lit(""))
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), host_of(address).alias("host"), path_of(address).alias("path"))
    verdicts = {r.text: r.verdict for r in rules}
    blocked = [r.text for r in rules if r.verdict == "block"]
    rows = rows.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)).withColumn("segments", segments_of(F.col("path"), cfg))
    counts = rows.groupBy("host", "segments").agg(
        F.count("*").alias("n"), F.count(F.when(F.col("rule").isin(blocked), 1)).alias("blocked"), F.count("rule").alias("labelled")
    )
    grown = grow(materialize(counts, "paths"), cfg)
    rated = _sums(grown, "host", "template")
    hosts = rated.groupBy("host").agg(F.sum("blocked").alias("all_blocked"), F.sum("labelled").alias("all_labelled"))
    elsewhere = F.col("all_blocked") - F.col("blocked"), F.col("all_labelled") - F.col("labelled")
    prior = 0.25 + 0.5 * (elsewhere[0] + cfg.strength / 2) / (elsewhere[1] + cfg.strength)
    purity = (F.col("blocked") + cfg.strength * prior) / (F.col("labelled") + cfg.strength)
    rated = rated.join(hosts, "host").select("host", "template", purity.alias("purity"))
    judged = materialize(grown.select("host", "segments", "template").join(rated, ["host", "template"]), "templates")
    known = F.create_map(*[F.lit(x) for pair in verdicts.items() for x in pair])[F.col("rule")] if rules else F.lit(None).cast("string")
    own = F.when(F.col("purity") >= cfg.reject, "block").otherwise("allow")
    # Unhinted: broadcast while the stored templates are small, else a join whose hot paths are split at run time.
    return rows.join(judged, ["host", "segments"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce(known, own).alias("verdict"), F.concat(F.lit("/"), F.array_join("template", "/")).alias("template"), "purity"
    )

"""URL filters: explicit rules first, then a tree of path templates judged by labelled purity.

Only DataFrame and SQL functions are used.

*Parts.* The host is what follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case, the
path what follows up to ``?``, ``#`` or the end. A null url or one without ``://`` has an empty host and path.

*Rules* (host, path, verdict) fit the host and its subdomains when the path starts with the rule's; the longest wins.
They are a short list, kept in the plan.

*Templates.* Within a host, numbers in a segment become ``#`` and everything below ``DEPTH`` segments ``**``. Level by
level, a node with ``KINDS`` or more different next segments, on average on no more than ``1 / RARE`` pages each, has them
replaced by ``*``. Leaf templates of one parent whose share of good pages does not differ from that of their siblings
(a two-proportion z-test below ``SIMILAR``) are merged. A branch's purity is its share of good labelled pages, smoothed
with ``PRIOR`` pages of its host's share, which is smoothed alike with the share of all hosts; without any label it is 1.
Branches below ``threshold`` are blocked. All counts are over hosts and templates, so a host with a third of all pages is
a few rows after the first, partial aggregation.

Every row is returned, repeated rows as often as they occur. Extra columns stay; columns named like results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrays import discard, stored

DEPTH, KINDS, RARE = 6, 20, 0.5
SIMILAR, PRIOR, THRESHOLD = 1.96, 20.0, 0.5
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

Rule = tuple[str, str, str]


def parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or null."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(start))
        out = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def shape(path: Column) -> Column:
    """A path with its numbers replaced and everything below DEPTH segments folded."""
    segments = F.slice(F.split(path, "/"), 2, 1_000_000)
    short = F.when(F.size(segments) > DEPTH, F.concat(F.slice(segments, 1, DEPTH), F.array(F.lit("**")))).otherwise(segments)
    return F.array_join(F.transform(short, lambda s: F.regexp_replace(s, "[0-9]+", "#")), "/")


def templates(shapes: DataFrame) -> DataFrame:
    """Add ``template`` to rows (host, shape, n, ...), one for each host and shape.

    Every level reads the one above twice, so each is stored: in one plan they would double it level by level.
    """
    segments = F.split("shape", "/")
    deepest = shapes.agg(F.max(F.size(segments))).first()[0] or 0
    tree = shapes.withColumn("template", F.lit(""))
    for depth in range(min(DEPTH + 1, deepest)):
        above, tree = tree, tree.withColumn("_next", F.get(segments, F.lit(depth)))
        below = tree.where(F.col("_next").isNotNull()).groupBy("host", "template")
        kinds = below.agg(F.countDistinct("_next").alias("kinds"), F.sum("n").alias("pages"))
        wild = kinds.where((F.col("kinds") >= KINDS) & (F.col("kinds") >= RARE * F.col("pages"))).select("host", "template", F.lit(True).alias("_wild"))
        step = F.when(F.col("_wild") & (F.col("_next") != "**"), F.lit("*")).otherwise(F.col("_next"))
        tree = tree.join(wild, ["host", "template"], "left")
        longer = F.concat("template", F.lit("/"), step)
        tree = tree.withColumn("template", F.when(F.col("_next").isNull(), F.col("template")).otherwise(longer)).drop("_wild", "_next")
        tree = stored(tree, "url-templates")
        if depth:
            discard(above)
    return tree


def purities(leaves: DataFrame) -> DataFrame:
    """Add ``purity`` to templates (host, template, good, bad)."""
    leaves = leaves.withColumn("parent", F.regexp_replace("template", "/[^/]*$", ""))
    around = leaves.groupBy("host", "parent").agg(F.sum("good").alias("all_good"), F.sum(F.col("good") + F.col("bad")).alias("all"))
    # Without labels on one side, or with all labels alike, z is null: nothing to tell the branch apart by.
    parts_ = leaves.join(around, ["host", "parent"]).withColumn("_n", F.col("good") + F.col("bad")).withColumn("_others", F.col("all") - F.col("_n"))
    rate = F.try_divide(F.col("all_good"), F.col("all"))
    gap = F.try_divide(F.col("good"), F.col("_n")) - F.try_divide(F.col("all_good") - F.col("good"), F.col("_others"))
    spread = rate * (1 - rate) * (F.try_divide(F.lit(1), F.col("_n")) + F.try_divide(F.lit(1), F.col("_others")))
    z = F.try_divide(F.abs(gap), F.sqrt(spread))
    similar = F.coalesce(z < SIMILAR, F.lit(True))
    leaves = parts_.withColumn("branch", F.when(similar, F.lit("")).otherwise(F.col("template")))
    merged = leaves.groupBy("host", "parent", "branch").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    hosts = leaves.groupBy("host").agg(F.sum("good").alias("host_good"), F.sum("bad").alias("host_bad"))
    overall = leaves.agg(F.sum("good").alias("g"), F.sum("bad").alias("b")).select(
        F.coalesce(F.try_divide(F.col("g"), F.col("g") + F.col("b")), F.lit(1.0)).alias("overall")
    )
    share = F.lit(overall.first()["overall"])
    hosts = hosts.select("host", ((F.col("host_good") + PRIOR * share) / (F.col("host_good") + F.col("host_bad") + PRIOR)).alias("host_share"))
    judged = merged.join(hosts, "host").withColumn("purity", (F.col("good") + PRIOR * F.col("host_share")) / (F.col("good") + F.col("bad") + PRIOR))
    return leaves.select("host", "template", "parent", "branch").join(judged.select("host", "parent", "branch", "purity"), ["host", "parent", "branch"])


def judge(
    pages: DataFrame, labels: DataFrame, rules: list[Rule], url: str = "url", threshold: float = THRESHOLD
) -> DataFrame:
    """Add ``host``, ``path``, ``rule``, ``verdict``, ``template`` and ``purity`` to every row.

    ``labels`` has one row (url, good) for each labelled page, good being 1 or 0; nulls count as no label.
    """
    added = ["host", "path", "rule", "verdict", "template", "purity"]
    kept = [c for c in pages.columns if c not in added]
    host, path = parts(F.col(url))
    split = pages.select(*kept, host.alias("host"), path.alias("path")).withColumn("_shape", shape(F.col("path")))
    label_host, label_path = parts(F.col("url"))
    known = labels.where("good is not null").select(label_host.alias("host"), shape(label_path).alias("shape"), F.col("good").cast("long").alias("good"))
    seen = split.select("host", F.col("_shape").alias("shape"), F.lit(1).alias("n"), F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("bad"))
    told = known.select("host", "shape", F.lit(0).alias("n"), "good", (1 - F.col("good")).alias("bad"))
    sums = [F.sum(c).alias(c) for c in ("n", "good", "bad")]
    shapes = stored(seen.unionByName(told).groupBy("host", "shape").agg(*sums), "url-shapes")
    tree = templates(shapes)
    leaves = tree.groupBy("host", "template").agg(*sums[1:])
    named = tree.select("host", "shape", "template").join(purities(stored(leaves, "url-leaves")), ["host", "template"])
    named = stored(named.select("host", F.col("shape").alias("_shape"), "template", "purity"), "url-purities")
    rule = rule_of(F.col("host"), F.col("path"), rules)
    judged = split.join(named, ["host", "_shape"], "left").withColumn("_rule", rule)
    method = F.when(F.col("purity") < threshold, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        *kept, "host", "path", F.col("_rule.rule").alias("rule"), F.coalesce("_rule.verdict", method).alias("verdict"), "template", "purity"
    )

"""Mix sources to target weights: budgets for a tree of domain, language and source, then a token prefix of each leaf.

Only DataFrame and SQL functions are used.

*Budgets.* A leaf can give ``epochs`` times its tokens, a node what its leaves can give. From the root down, a node's
budget is shared among its children by weight; a child that can give less than its share is filled to the brim and what
it lacks goes to its siblings, again by weight. A node never gets more than its leaves can give, so only a shortage that
the siblings cannot take reaches the parent's level. Shares are whole tokens: what rounding leaves goes, one token each,
to the open siblings in order of their names. All budgets add up to ``budget``, or to what there is.

*Prefix.* A leaf's documents stand in the order of a seeded hash, a new order for every epoch. It gives whole epochs and
of the next one the shortest prefix that reaches its budget; ``take_tokens`` of the last document is cut to the budget.

A document counts ``tokens`` tokens: words between blanks by default. Documents without tokens (null, empty) are never
selected. Null domains, languages and sources are nodes of their own. Rows of equal id in a leaf are one unit: they are
taken together or not at all, each in full, the first place counting. Weights that are null, negative or zero give
nothing; weights of names that do not occur count nothing; names without a weight get ``default_weight``.
Extra columns stay; columns named like results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import free_name, stored

#: Weights are whole numbers of this unit, so that shares are computed without rounding.
UNIT = 1_000_000
BUCKETS = 1024
LEVELS = ("domain", "lang", "source")


def word_count(text: str = "text") -> Column:
    """Words between blanks; null and empty texts have none."""
    trimmed = F.trim(F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"\s+", " "))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1).cast("long")


def first_words(text: Column, count: Column) -> Column:
    """A text up to the end of its first ``count`` words between blanks; one with fewer words as it is."""
    return F.array_join(F.slice(F.split(text, r"(?<=\S)(?=\s)"), F.lit(1), count.cast("int")), "")


def place(seed: int, epoch: Column, id_: Column) -> Column:
    """The place of a document in an epoch's order: 16 hexadecimal digits."""
    return F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), id_.cast("string"))), 1, 16)


def _matched(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of equal names, null matching null, and keep the left ones."""
    renamed = right.withColumnsRenamed({k: f"_of_{k}" for k in keys})
    joined = left.join(renamed, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys], how)
    return joined.drop(*[f"_of_{k}" for k in keys])


def _weight(names: Column, weights: dict[str, float], default: float) -> Column:
    out = F.lit(round(default * UNIT))
    for name, value in sorted(weights.items()):
        out = F.when(names == name, F.lit(max(0, round((value or 0) * UNIT)))).otherwise(out)
    return out.cast("long")


def _share(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Add ``share``: each child's part of its parent's ``given``, by ``weight`` and at most ``room``."""
    big = "decimal(38,0)"
    # Children fill up in order of room per weight; while one is full, all before it are.
    siblings = Window.partitionBy(*parent)
    ratio = F.try_divide(F.col("room"), F.col("weight"))
    order = siblings.orderBy(ratio.asc_nulls_last(), F.col(name).asc_nulls_first())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onward = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    filled = F.coalesce(F.sum("room").over(before), F.lit(0))
    left = F.greatest(F.col("given") - filled, F.lit(0)).cast(big)
    children = children.withColumn("_left", left).withColumn("_weights", F.sum("weight").over(onward).cast(big))
    full = (F.col("weight") > 0) & (F.col("room").cast(big) * F.col("_weights") <= F.col("_left") * F.col("weight").cast(big))
    children = children.withColumn("_full", F.min(full.cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    open_ = ~F.col("_full") & (F.col("weight") > 0)
    first_left = F.max(F.when(open_, F.col("_left"))).over(siblings)
    all_weights = F.max(F.when(open_, F.col("_weights"))).over(siblings)
    children = children.withColumn("_part", F.when(open_, F.expr("0L")).otherwise(F.when(F.col("_full"), F.col("room")).otherwise(F.lit(0))).cast("long"))
    children = children.withColumn("_open_left", first_left).withColumn("_open_weights", all_weights).withColumn("_open", open_)
    children = children.withColumn("_part", F.when(F.col("_open"), F.expr("_open_left * cast(weight as decimal(38,0)) div _open_weights")).otherwise(F.col("_part")).cast("long"))
    spare = F.col("_open_left").cast("long") - F.sum(F.when(F.col("_open"), F.col("_part"))).over(siblings)
    turn = F.row_number().over(siblings.orderBy(F.col("_open").desc(), F.col(name).asc_nulls_first()))
    extra = F.when(F.col("_open") & (turn <= spare), F.lit(1)).otherwise(F.lit(0))
    shared = children.withColumn("share", (F.col("_part") + extra).cast("long"))
    return shared.drop("_left", "_weights", "_full", "_part", "_open_left", "_open_weights", "_open")


def budgets(leaves: DataFrame, budget: int | Column, epochs: int, weights: dict[str, dict[str, float]], default_weight: float = 1.0) -> DataFrame:
    """Add ``budget`` to leaves (domain, lang, source, tokens)."""
    nodes = leaves.withColumn("room", F.col("tokens") * epochs)
    path: list[str] = []
    given = nodes.agg(F.least(F.sum("room"), F.lit(budget) if isinstance(budget, int) else budget).alias("given"))
    parents = given.withColumn("_root", F.lit(0))
    tree = nodes.withColumn("_root", F.lit(0))
    for level in LEVELS:
        above = ["_root", *path]
        path.append(level)
        children = tree.groupBy("_root", *path).agg(F.sum("room").alias("room"))
        children = children.withColumn("weight", _weight(F.col(level), weights.get(level, {}), default_weight))
        # A subtree without weight can take nothing, so its room counts for nothing on the way down.
        children = children.withColumn("room", F.when(F.col("weight") > 0, F.col("room")).otherwise(F.lit(0)))
        held = _matched(children, parents, above)
        parents = _share(held, above, level).select("_root", *path, F.col("share").alias("given"))
    matched = _matched(leaves, parents.drop("_root"), list(LEVELS), "left")
    return matched.select(*leaves.columns, F.coalesce("given", F.lit(0)).alias("budget"))


def mix(
    docs: DataFrame, domain: Column, budget: float | int, weights: dict[str, dict[str, float]] | None = None,
    epochs: int = 2, seed: int = 17, tokens: Column | None = None, id_column: str = "doc_id", default_weight: float = 1.0,
) -> DataFrame:
    """The selected documents, once for each epoch that takes them, with ``domain``, ``epoch`` and ``take_tokens``.

    ``budget`` is a number of tokens, or as a fraction (float) a multiple of all tokens there are.
    """
    kept = [c for c in docs.columns if c not in ("domain", "epoch", "take_tokens")]
    named = docs.select(*kept, domain.alias("domain"))
    count = word_count() if tokens is None else tokens.cast("long")
    narrow = named.select(F.col(id_column).alias("_id"), *LEVELS, count.alias("_tokens"))
    # The only pass over the texts: from here on, a document is its id, its leaf and its length.
    units = narrow.where("_tokens > 0 and _id is not null").groupBy("_id", *LEVELS).agg(F.sum("_tokens").alias("tokens"))
    units = stored(units, "mix-units")
    leaves = stored(units.groupBy(*LEVELS).agg(F.sum("tokens").alias("tokens")), "mix-leaves")
    if isinstance(budget, float):
        whole = leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
        budget = int(whole * budget)
    shares = budgets(leaves, int(budget), epochs, weights or {}, default_weight)
    shares = shares.withColumn("full", F.floor(F.col("budget") / F.col("tokens"))).withColumn("rest", F.col("budget") - F.col("full") * F.col("tokens"))
    shares = stored(shares.where("budget > 0").select(*LEVELS, F.col("full").cast("int").alias("full"), "rest"), "mix-shares")
    placed = _matched(units, shares, list(LEVELS)).withColumn("at", place(seed, F.col("full"), F.col("_id")))
    placed = placed.withColumn("bucket", F.conv(F.substring("at", 1, 3), 16, 10).cast("int"))
    # Tokens before each bucket of places, so that no leaf is ordered as a whole.
    sums = placed.groupBy(*LEVELS, "bucket").agg(F.sum("tokens").alias("inside"))
    running = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = stored(sums.withColumn("before", F.coalesce(F.sum("inside").over(running), F.lit(0))), "mix-buckets")
    with_before = _matched(placed, sums, [*LEVELS, "bucket"])
    # Buckets all before the cut are taken whole, those behind it not at all; only those at the cut are put in order.
    inner = Window.partitionBy(*LEVELS, "bucket").orderBy("at", "_id").rowsBetween(Window.unboundedPreceding, -1)
    cut = with_before.where((F.col("before") < F.col("rest")) & (F.col("before") + F.col("inside") > F.col("rest")))
    cut = cut.withColumn("start", F.col("before") + F.coalesce(F.sum("tokens").over(inner), F.lit(0)))
    cut = cut.select("_id", *LEVELS, "tokens", "full", F.least(F.col("tokens"), F.col("rest") - F.col("start")).alias("last"))
    settled = with_before.where(~((F.col("before") < F.col("rest")) & (F.col("before") + F.col("inside") > F.col("rest"))))
    last = F.when(F.col("before") + F.col("inside") <= F.col("rest"), F.col("tokens")).otherwise(F.lit(0))
    chosen = settled.select("_id", *LEVELS, "tokens", "full", last.alias("last")).unionByName(cut)
    chosen = chosen.select("_id", *LEVELS, "tokens", "full", F.greatest("last", F.lit(0)).alias("last"))
    chosen = chosen.withColumn("_epochs", F.col("full") + (F.col("last") > 0).cast("int")).where("_epochs > 0")
    own, taken_as = free_name(named, "id"), free_name(named, "taken")
    levels = {c: free_name(named, f"of_{c}") for c in LEVELS}
    names = [F.col(c).alias(name) for c, name in levels.items()]
    chosen = chosen.select(F.col("_id").alias(own), *names, F.struct("tokens", "full", "last", "_epochs").alias(taken_as))
    # An id is in one leaf, unless ids repeat: the shuffle is by id, which spreads a source of any size.
    same = (F.col(id_column) == F.col(own)) & F.forall(
        F.array(*[F.col(c).eqNullSafe(F.col(name)) for c, name in levels.items()]), lambda equal: equal
    )
    part = {f: F.col(f"{taken_as}.{f}") for f in ("tokens", "full", "last", "_epochs")}
    taken = named.join(chosen, same).withColumn("epoch", F.explode(F.sequence(F.lit(0), part["_epochs"] - 1)))
    take = F.when(F.col("epoch") < part["full"], part["tokens"]).otherwise(part["last"]).cast("long")
    return taken.select(*kept, "domain", "epoch", take.alias("take_tokens"))

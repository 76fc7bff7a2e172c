"""Mixing sources to target weights: budgets go down a tree, and each leaf gives the first tokens of seeded epochs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstream.llm.components import saved

LEVELS = ("domain", "lang", "source")
SEED = 42
EPOCHS = 2  # times that a document is taken at most
SHARE = 0.5  # of the corpus' tokens that the mixture has
BUCKETS = 4096  # parts of a leaf's epoch; only the part in which its budget ends is sorted
# Weights by level and name; a name without one counts 1.
WEIGHTS = {"domain": {"d0": 4.0, "d1": 3.0, "d2": 2.0, "d3": 1.0}, "lang": {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0}}


def domain_of(source: Column) -> Column:
    """The domain that a source belongs to, where the table has none: four groups of sources by hash."""
    return F.concat(F.lit("d"), F.pmod(F.crc32(F.coalesce(source, F.lit(""))), F.lit(4)).cast("string"))


def words(text: Column) -> Column:
    """Runs of characters other than white space; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def matched(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on equal keys, null and null included; the keys appear once."""
    other = right.select(*[F.col(c).alias(f"__{c}") for c in keys], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"__{key}"))
    return left.join(other, same).drop(*[f"__{c}" for c in keys])


def weight_of(level: str, weights: Mapping[str, Mapping[str, float]]) -> Column:
    known = weights.get(level) or {}
    if not known:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
    return F.coalesce(table[F.col(level)], F.lit(1.0))


def poured(nodes: DataFrame, parent: Sequence[str]) -> DataFrame:
    """Adds ``given`` to the nodes: their parent's ``budget`` in proportion to ``weight``, up to ``supply``.

    What a node cannot take goes to its siblings in proportion to their weights. In ascending order of supply by weight, the
    level to which all are filled is the first that does not exceed the next node's ratio.
    """
    ratio = F.when(F.col("weight") > 0, F.col("supply") / F.col("weight"))
    # Without weight, or without supply, a node takes nothing; without an end of the order the level is that of plenty.
    by = Window.partitionBy(*parent)
    order = by.orderBy(F.col("ratio").asc_nulls_last(), *[F.col(c) for c in nodes.columns if c in LEVELS])
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    filled = F.coalesce(F.sum("supply").over(before), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = nodes.withColumn("ratio", ratio).withColumn("level", F.when(left > 0, (F.col("budget") - filled) / left))
    level = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(by)["level"]
    given = F.least(F.col("supply").cast("double"), F.greatest(F.lit(0.0), level) * F.col("weight"))
    given = F.when(F.col("weight") <= 0, 0.0).when(level.isNull(), F.col("supply").cast("double")).otherwise(given)
    return rows.withColumn("given", given).drop("ratio", "level")


def budgets(leaves: DataFrame, weights: Mapping[str, Mapping[str, float]], share: float, epochs: int) -> DataFrame:
    """``leaves``: the levels and ``tokens``. Adds ``given``, the tokens to take from each.

    A shortage below a node stays below it while the node's other leaves can make it up, and only then goes to the node's
    siblings: a node's supply is that of all its leaves, so a budget that reaches it can be met there.
    """
    total = leaves.agg(F.sum("tokens").alias("n")).first()["n"] or 0
    current = None
    for depth in range(1, len(LEVELS) + 1):
        parent, path = list(LEVELS[: depth - 1]), list(LEVELS[:depth])
        nodes = leaves.groupBy(*path).agg((F.sum("tokens") * epochs).cast("double").alias("supply"))
        nodes = nodes.withColumn("weight", weight_of(path[-1], weights))
        if parent:
            nodes = matched(nodes, current, parent)
        else:
            nodes = nodes.withColumn("budget", F.lit(float(total * share)))
        current = poured(nodes, parent).select(*path, F.col("given").alias("budget"))
    return current.withColumnRenamed("budget", "given")


def mixture(
    docs: DataFrame,
    weights: Mapping[str, Mapping[str, float]] = WEIGHTS,
    share: float = SHARE,
    epochs: int = EPOCHS,
    seed: int = SEED,
) -> DataFrame:
    """One row for each time a document is taken: doc_id, domain, lang, source, epoch (from 0), n_tokens, taken.

    ``docs`` has doc_id, text, lang, source. Tokens are words. The budget is ``share`` of all tokens. A leaf whose budget is
    ``e`` times its tokens and a rest gives ``e`` whole epochs and, in the order by a hash of seed, epoch and id, the first
    tokens of one more, as many as the rest: of the document in which they end, the first ``taken`` of its tokens. Null languages and sources are leaves of their own; null and
    empty texts have no tokens and are never taken. Repeated rows are taken as rows of their own. Nothing is taken of an
    empty table.
    """
    slim = docs.select("doc_id", domain_of(F.col("source")).alias("domain"), "lang", "source", words(F.col("text")).alias("n_tokens"))
    slim = saved(slim.where("n_tokens > 0"), "tokens")
    leaves = slim.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens"))
    given = budgets(leaves, weights, share, epochs)
    plan = matched(leaves, given, LEVELS).select(
        *LEVELS,
        F.floor(F.col("given") / F.col("tokens") + 1e-9).cast("int").alias("whole"),
        F.floor(F.col("given") - F.floor(F.col("given") / F.col("tokens") + 1e-9) * F.col("tokens") + 1e-6).alias("rest"),
    )
    plan = saved(plan, "budgets")
    rows = matched(slim, plan, LEVELS)
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), "whole", "doc_id"))
    rows = rows.withColumn("bucket", F.shiftrightunsigned("key", 52).cast("int"))
    parts = rows.groupBy(*LEVELS, "bucket").agg(F.sum("n_tokens").alias("sum"))
    upto = Window.partitionBy(*LEVELS).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("sum").over(upto), F.lit(0)))
    rows = matched(rows, parts, [*LEVELS, "bucket"])
    first = rows.where("before + sum <= rest")
    cut = rows.where("before < rest and before + sum > rest")
    running = Window.partitionBy(*LEVELS, "bucket").orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("begins", F.col("before") + F.sum("n_tokens").over(running) - F.col("n_tokens")).where("begins < rest")
    cut = cut.withColumn("taken", F.least("n_tokens", F.col("rest") - F.col("begins"))).drop("begins")
    columns = ["doc_id", *LEVELS, "n_tokens"]
    first = first.withColumn("taken", F.col("n_tokens"))
    last = first.unionByName(cut).select(*columns, "taken", F.col("whole").alias("epoch"))
    full = matched(slim, plan.where("whole > 0"), LEVELS)
    full = full.select(*columns, F.col("n_tokens").alias("taken"), F.explode(F.sequence(F.lit(0), F.col("whole") - 1)).alias("epoch"))
    return full.unionByName(last).select("doc_id", *LEVELS, "epoch", "n_tokens", "taken")

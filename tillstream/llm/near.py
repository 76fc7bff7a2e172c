"""Links between sets that share a group key, without comparing all pairs of a group.

First each set is compared with one member of each of its groups. The tokens in which they differ from it are few, and tell in
which tokens any two of them differ; so each group gets a better centre, the member nearest to what most of it have, and
the differences from that one, without comparing anything again. Links with both make components. Then only pairs of different
components that share a key are looked at, in two ways. With a centre in common: if neither is far from it, both are linked with
it, and need no look. If one is too far, the two can only be linked if their differences have enough in common, and that needs
a common token in prefixes of the differences: this gives few pairs, and the differences decide. All other pairs are
compared as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.components import components, saved

DIFFERENCES_FROM = 0.6  # differences are kept where sets share more than that of the greater one


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct pairs (a, b) with their sets s_a and s_b, the sizes n_a and n_b of these, and that of what they share, ``common``."""
    one, two = (sets.select(F.col("node").alias(x), F.size("tokens").alias(f"n_{x}"), F.col("tokens").alias(f"s_{x}")) for x in "ab")
    both = pairs.join(two, "b").join(one, "a")
    return both.withColumn("common", F.size(F.array_intersect("s_a", "s_b")).cast("long"))


def linked(pairs: DataFrame, percent: int) -> DataFrame:
    return pairs.where(100 * F.col("common") >= percent * (F.col("n_a") + F.col("n_b") - F.col("common"))).select("a", "b")


def minus(x: str, y: str) -> Column:
    return F.array_except(x, y)


def with_centres(groups: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links found by comparing each node with its groups' centres, the components they make, and the differences.

    ``groups`` has node, p (a member of a group of the node); ``sets`` has node, tokens. The links are (a, b), the components
    (node, root). The differences have a row for each node and group: node, n, p (the group), n_p (the size of its centre) and
    diff, the tokens in which node and centre differ, first those that the centre lacks. Nodes that have little in common with
    ``p`` have no row for it.
    """
    pairs = groups.where("node <> p").select(F.col("p").alias("a"), F.col("node").alias("b")).distinct()
    near = F.col("common") > DIFFERENCES_FROM * F.greatest("n_a", "n_b")
    first = compared(pairs, sets).select(
        "a", "b", "n_a", "n_b", "common", F.when(near, minus("s_b", "s_a")).alias("more"), F.when(near, minus("s_a", "s_b")).alias("less")
    )
    first = saved(first, "compared")
    none = F.array().cast("array<bigint>")
    rows = first.where("more is not null").select(F.col("a").alias("p"), F.col("b").alias("node"), F.col("n_b").alias("n"), "more", "less")
    selves = first.where("more is not null").select(F.col("a").alias("p"), F.col("a").alias("node"), F.col("n_a").alias("n")).distinct()
    rows = rows.unionByName(selves.withColumns({"more": none, "less": none}))
    # What most members of a group have and its first member has not, or the other way round.
    size = rows.groupBy("p").agg(F.count("*").alias("size"))
    common = rows.select("p", F.explode(F.concat("more", "less")).alias("token")).groupBy("p", "token").agg(F.count("*").alias("often"))
    common = common.join(size, "p").where("2 * often > size").groupBy("p").agg(F.collect_list("token").alias("most"))
    own = F.concat("more", "less")
    off = F.size(own) + F.size("most") - 2 * F.size(F.array_intersect(own, F.col("most")))
    scored = rows.join(common, "p", "left").withColumn("most", F.coalesce("most", none))
    best = F.min(F.struct(off.alias("off"), "node", "n", "more", "less"))
    centre = scored.groupBy("p").agg(best.alias("c")).select("p", *[F.col(f"c.{c}").alias(f"{c}_c") for c in ("node", "n", "more", "less")])
    moved = rows.join(centre, "p")
    lacks = F.concat(F.array_except("more", "more_c"), F.array_except("less_c", "less"))
    has = F.concat(F.array_except("less", "less_c"), F.array_except("more_c", "more"))
    diff = F.concat(F.array_sort(lacks), F.array_sort(has)).alias("diff")
    moved = saved(moved.select("node", "n", "p", F.col("node_c").alias("centre"), F.col("n_c").alias("n_p"), diff), "differences")
    close = moved.where("node <> centre").where((100 + percent) * F.size("diff") <= (100 - percent) * (F.col("n") + F.col("n_p")))
    links = linked(first, percent).union(close.select(F.col("centre").alias("a"), F.col("node").alias("b"))).distinct()
    links = saved(links, "near")
    return links, components(links), moved.drop("centre")


def with_facts(nodes: DataFrame, roots: DataFrame, differences: DataFrame) -> DataFrame:
    """The nodes with ``root`` and ``ps``, the groups for which their differences are known."""
    known = differences.groupBy("node").agg(F.collect_set("p").alias("ps"))
    facts = nodes.join(roots, "node", "left").join(known, "node", "left")
    return saved(facts.withColumn("root", F.coalesce("root", "node")), "facts")


def links_by_differences(differences: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All links (a, b) of nodes with a centre in common and different components.

    With ``t`` the share (100 - percent) / (100 + percent), linked sets differ in ``t * (n1 + n2)`` tokens at most. A node is far
    if it differs from its centre in more than ``t * (n + n_p)``. As a set has at most ``|D|`` tokens more than the centre, a far
    node and any other can only be linked with at least ``percent / (100 + percent) * |D|`` of the other's differences in
    common, and with half of what the far node's exceed that bound by. Differences are in one order for all of a centre's
    nodes, so the prefixes that these numbers leave have a token in common.
    """
    low, high = 100 - percent, 100 + percent
    facts = differences.where("size(diff) > 0").withColumn("d", F.size("diff")).join(roots, "node", "left")
    facts = facts.withColumn("root", F.coalesce("root", "node"))
    beyond = high * F.col("d") - low * (F.col("n") + F.col("n_p"))
    every = F.col("d") - F.ceil(percent * F.col("d") / high - 1e-9) + 1
    far = F.col("d") - F.ceil((beyond + high - low) / (2 * high) - 1e-9) + 1
    facts = facts.withColumn("far", beyond > 0)

    def tokens(rows: DataFrame, length: Column, x: str) -> DataFrame:
        prefix = F.slice("diff", F.lit(1), F.greatest(F.lit(0), F.least(length, F.col("d"))).cast("int"))
        others = [F.col(c).alias(f"{c}_{x}") for c in ("root", "n", "d", "far")]
        return rows.select("p", F.posexplode(prefix).alias(f"at_{x}", "token"), F.col("node").alias(x), *others)

    # At their first common difference, two nodes have no more in common than what follows in either; two far ones meet once.
    most = F.least(F.col("d_x") - F.col("at_x"), F.col("d_y") - F.col("at_y"))
    close = high * (F.col("d_x") + F.col("d_y") - 2 * most) <= low * (F.col("n_x") + F.col("n_y"))
    pairs = tokens(facts.where("far"), far, "x").join(tokens(facts, every, "y"), ["p", "token"])
    pairs = pairs.where("root_x <> root_y and (not far_y or x < y)").where(close)
    pairs = pairs.select("p", F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
    one, two = (facts.select("p", F.col("node").alias(x), F.col("n").alias(f"n_{x}"), F.col("diff").alias(f"d_{x}")) for x in "ab")
    differ = F.size("d_a") + F.size("d_b") - 2 * F.size(F.array_intersect("d_a", "d_b"))
    return pairs.join(two, ["p", "b"]).join(one, ["p", "a"]).where(high * differ <= low * (F.col("n_a") + F.col("n_b"))).select("a", "b")


def open_pairs(spread: DataFrame, keys: list[str], percent: int) -> DataFrame:
    """Distinct pairs (a, b) of different components and without a common centre that share a key, if their sizes allow a link.

    ``spread``: the keys, and node, n, rank, root, ps. Of a key's nodes those of the component of the least rank need not
    be compared with each other. If keys are tokens in one order for all sets, ``at`` tells the place of each in its set, from 0:
    at the first token in common, two sets share no more than what follows in either.
    """
    place = [c for c in ("at",) if c in spread.columns]
    mixed = spread.groupBy(*keys).agg(
        F.min("root").alias("low"), F.max("root").alias("high"), F.min(F.struct("rank", "root"))["root"].alias("main")
    )
    columns = ["node", "n", "root", "ps", *place]
    spread = spread.select(*keys, *columns).join(mixed.where("low <> high").select(*keys, "main"), keys)
    one = spread.where("root <> main").select(*keys, *[F.col(c).alias(f"{c}_a") for c in columns])
    two = spread.select(*keys, "main", *[F.col(c).alias(f"{c}_b") for c in columns])
    once = "root_a <> root_b and (root_b = main or node_a < node_b) and not coalesce(arrays_overlap(ps_a, ps_b), false)"
    sizes = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    if place:
        most = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
        sizes &= (100 + percent) * most >= percent * (F.col("n_a") + F.col("n_b"))
    pairs = one.join(two, keys).where(once).where(sizes)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()

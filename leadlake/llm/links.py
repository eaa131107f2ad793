"""From buckets of candidates to connected components, without all pairs of a bucket.

``linked_components`` gets memberships (key, node): nodes that share a key may be
linked, and a ``verify`` function that confirms pairs exactly.  It returns the
components that all true links among nodes sharing a key would give:

1. every node is tried with the smallest node it shares a key with (its star);
2. then with the smallest nodes of its other keys, unless they are already in one
   component;
3. keys whose members still lie in several components get a pivot, the smallest node of
   the component most of them are in.  Members of one pivot's keys in different
   components are the pairs left; the caller, who knows the sets or lines, says which of
   them are possible at all (``prefix_pairs`` does that without listing the others).

Rounds 1 and 2 make at most one pair per membership, and in a group of copies they join
nearly all members.  No pair that can be linked is dropped in any round.

Every round starts from written tables, so a lost executor costs a re-read.  What is
joined back to the rows it was aggregated from (the smallest node of a key or of a
neighbourhood) is written first: an aggregate has its rows' own partitioning, and only
against another table can AQE split the rows of a hot key.

Defined cases: keys and nodes are hashes or ids, never NULL; repeated memberships and edges count
once; of equally large components of a key the one with the smallest node gives the
pivot; without memberships or edges there are no components.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadlake.llm.common import discard, written

Verify = Callable[[DataFrame], DataFrame]
Narrow = Callable[[DataFrame], DataFrame]


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b longs): the component's
    smallest node.  Alternates large-star and small-star steps until a large-star step
    leaves stars; each step is an aggregation with map-side partials and an equi-join.
    Repeated edges are not sorted out on the way: no step makes more edges than it gets,
    and those to a node's smallest neighbour become one."""
    now = written(edges.select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v"), "edges")
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = written(both.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("c"), F.least("u", "m").alias("m")), "least")
        large = written(both.where("v > u").join(least, F.col("u") == F.col("c")).select(
            F.col("v").alias("u"), F.col("m").alias("v")), "large")
        children = written(large.groupBy("u").agg(F.min("v").alias("m"), F.max("v").alias("most")).select(
            F.col("u").alias("c"), "m", (F.col("m") != F.col("most")).alias("several")), "children")
        # stars: no child has two centres, and no centre is a child
        if children.where("several").isEmpty() and children.select(F.col("m").alias("centre")).join(
                children, F.col("centre") == F.col("c"), "left_semi").isEmpty():
            centre = children.select(F.col("c").alias("__c"), F.col("m").alias("component"))
            components = written(least.join(centre, F.col("c") == F.col("__c"), "left").select(
                F.col("c").alias("node"), F.coalesce("component", "c").alias("component")), "components")
            discard(now, least, large, children)
            return components
        after = written(
            large.join(children, F.col("u") == F.col("c")).where("v <> m").select(
                F.col("v").alias("u"), F.col("m").alias("v"))
            .union(children.select(F.col("c").alias("u"), F.col("m").alias("v"))), "edges")
        discard(now, least, large, children)
        now = after


def _labelled(pairs: DataFrame, components: DataFrame) -> DataFrame:
    """Adds ca and cb, the components of a and b (themselves where unlinked)."""
    ca = components.select(F.col("node").alias("__na"), F.col("component").alias("__ca"))
    cb = components.select(F.col("node").alias("__nb"), F.col("component").alias("__cb"))
    return (
        pairs.join(ca, F.col("a") == F.col("__na"), "left").join(cb, F.col("b") == F.col("__nb"), "left")
        .select(*pairs.columns, F.coalesce("__ca", "a").alias("ca"), F.coalesce("__cb", "b").alias("cb"))
    )


def shared_memberships(members: DataFrame) -> DataFrame:
    """The memberships (key, node, rep) of keys with at least two nodes; ``rep`` is the
    smallest node of the key."""
    keys = written(members.groupBy("key").agg(F.min("node").alias("rep"), F.max("node").alias("__most")).where(
        "rep <> __most").select(F.col("key").alias("__key"), "rep"), "shared-keys")
    # distinct before the join: behind it, it would need the join's partitioning, and a hot key stay whole
    return members.select("key", "node").distinct().join(keys, F.col("key") == F.col("__key")).select(
        "key", "node", "rep")


def linked_components(shared: DataFrame, verify: Verify, narrow: Narrow) -> DataFrame:
    """(node, component) for all nodes with a link; ``shared`` comes from
    ``shared_memberships`` and should be a written table.  ``narrow`` gets the groups left
    for round 3, (pivot, node, c, apart): members, their components and whether that is
    another one than the pivot's; it returns pairs (a, b) that include every possible
    link between members of different components."""
    stars = written(shared.where("node <> rep").select(
        F.col("node").alias("a"), F.col("rep").alias("b")).distinct(), "stars")
    first = stars.groupBy("a").agg(F.min("b").alias("b"))
    links = written(verify(first).select("a", "b"), "links")
    components = connected_components(links)

    tried = first.select(F.col("a").alias("__a"), F.col("b").alias("__b"))
    rest = stars.join(tried, (F.col("a") == F.col("__a")) & (F.col("b") == F.col("__b")), "left_anti")
    rest = written(_labelled(rest, components).where("ca <> cb").select("a", "b"), "rest")
    if not rest.isEmpty():
        more = written(verify(rest).select("a", "b"), "links")
        if not more.isEmpty():
            links = links.union(more)
            components = connected_components(links)

    groups = _open_groups(shared, components)
    if groups.isEmpty():
        return components
    seen = stars.select(F.col("a").alias("__a"), F.col("b").alias("__b"))
    ordered = narrow(groups).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    cross = written(ordered.join(
        seen, (F.col("a") == F.col("__a")) & (F.col("b") == F.col("__b")), "left_anti"), "cross")
    if not cross.isEmpty():
        more = written(verify(cross).select("a", "b"), "links")
        if not more.isEmpty():
            components = connected_components(links.union(more))
    return components


def _open_groups(shared: DataFrame, components: DataFrame) -> DataFrame:
    """(pivot, node, c, apart) for the keys with members in several components."""
    own = components.select(F.col("node").alias("__n"), "component")
    labelled = shared.join(own, F.col("node") == F.col("__n"), "left").select(
        "key", "node", F.coalesce("component", "node").alias("c"))
    keys = written(labelled.groupBy("key", "c").count().groupBy("key").agg(
        F.max(F.struct("count", (-F.col("c")).alias("c"))).alias("top"), F.count("*").alias("several")
    ).where("several > 1").select(F.col("key").alias("__key"), (-F.col("top.c")).alias("pivot")), "open-keys")
    members = labelled.join(keys, F.col("key") == F.col("__key"))
    return written(members.select(
        "pivot", "node", "c", (F.col("c") != F.col("pivot")).alias("apart")).distinct(), "open")


def prefix_pairs(
    tokens: DataFrame, members: DataFrame, close: Callable[[Column, Column], Column]
) -> DataFrame:
    """Pairs (a, b) of a pivot's members, in different components, that share a token
    among the first ones of both.

    ``tokens`` has the distinct tokens (pivot, node, token) of the ``members`` (pivot,
    node, c, n, level, reach, apart_reach), which say how many of a member's tokens,
    rarest in the group first, a possible partner must share one of: ``reach`` when the
    member is found, and when it looks for partners of level k, ``apart_reach[k]`` (0: it
    does not).  ``close`` says whether two members' ``n`` may be linked.  Tokens that only
    one member has take the first places and match nothing."""
    held = written(tokens.groupBy("pivot", "token").agg(F.count("*").alias("held")).where("held > 1").select(
        F.col("pivot").alias("__pivot"), F.col("token").alias("__token"), "held"), "held")
    common = tokens.join(held, (F.col("pivot") == F.col("__pivot")) & (F.col("token") == F.col("__token"))).select(
        "pivot", "node", "token", "held")
    shared = common.groupBy("pivot", "node").agg(F.count("*").alias("shared"))
    every = tokens.groupBy("pivot", "node").agg(F.count("*").alias("every"))

    def keyed(df: DataFrame, tag: str) -> DataFrame:
        return df.withColumnsRenamed({"pivot": f"__p{tag}", "node": f"__n{tag}"})

    def on(tag: str) -> Column:
        return (F.col("pivot") == F.col(f"__p{tag}")) & (F.col("node") == F.col(f"__n{tag}"))

    # members with a place left behind the tokens that are theirs alone
    most = F.greatest("reach", F.array_max("apart_reach"))
    asked = members.join(keyed(every, "e"), on("e")).join(keyed(shared, "s"), on("s")).select(
        *members.columns, (F.col("every") - F.col("shared")).alias("alone")).where(F.col("alone") < most)
    placed = common.join(keyed(asked, "m"), on("m")).withColumn(
        "place", F.row_number().over(Window.partitionBy("pivot", "node").orderBy("held", "token")) + F.col("alone"))
    placed = written(placed.where(F.col("place") <= most).select(
        "pivot", "node", "c", "token", "n", "level", "place", "reach", "apart_reach"), "prefixes")
    # a row only for levels at which the group has members, and that the place is in reach of
    sought = written(placed.where("place <= reach").groupBy("pivot").agg(F.collect_set("level").alias("levels")).select(
        F.col("pivot").alias("__pivot"), "levels"), "levels")
    levels = F.filter("levels", lambda k: F.col("place") <= F.get(F.col("apart_reach"), k))
    one = placed.join(sought, F.col("pivot") == F.col("__pivot")).select(
        "pivot", "token", F.col("node").alias("a"), F.col("c").alias("__ca"), F.col("n").alias("__na"),
        F.explode(levels).alias("__level"))
    other = placed.where("place <= reach").select(
        F.col("pivot").alias("__pivot"), F.col("token").alias("__token"), F.col("node").alias("b"),
        F.col("c").alias("__cb"), F.col("n").alias("__nb"), "level")
    return one.join(other, (F.col("pivot") == F.col("__pivot")) & (F.col("token") == F.col("__token"))
                    & (F.col("__level") == F.col("level"))
                    & (F.col("__ca") != F.col("__cb")) & close(F.col("__na"), F.col("__nb"))).select("a", "b")

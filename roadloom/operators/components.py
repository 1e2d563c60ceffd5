"""Connected components for the map passes: least-label propagation with pointer jumping, on the graph's own tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadloom.operators.skew import relay_join
from roadloom.storage import Scratch


def components(edges: DataFrame, scope: str, a: str, b: str) -> DataFrame:
    """(scope, node, component): the least node of each node's component, for all nodes that occur in an edge.

    A label that very many nodes have, as in a component that holds most of a map, is spread over salts in both joins.
    Alternates connecting every node's neighbours to its least neighbour and its own label, which makes long chains
    shrink by half a round; the edge set is written to the shared folder each round, and only a sum comes back. Meant
    for the graphs of maps, whose components stay inside a map. Nulls are left out. The written tables are never broadcast:
    Spark estimates them by their files, which encoding makes ten times smaller than the rows.
    """
    spark = edges.sparkSession
    store = Scratch(spark, "components")
    one = edges.select(F.col(scope).alias("s"), F.col(a).alias("u"), F.col(b).alias("v")).dropna()
    both = one.union(one.select("s", F.col("v").alias("u"), F.col("u").alias("v"))).distinct()
    state = store.save(both.groupBy("s", "u").agg(F.least(F.min("v"), F.first("u")).alias("label")), "label-0").hint("merge")
    links = store.save(both.where("u <> v"), "links").hint("merge")
    turn, before = 0, None
    while True:
        turn += 1
        near = links.join(state.select("s", F.col("u").alias("v"), F.col("label").alias("l")), ["s", "v"]).groupBy("s", "u").agg(F.min("l").alias("l"))
        low = state.join(near, ["s", "u"], "left").select("s", "u", "label", F.least("label", F.coalesce("l", "label")).alias("low"))
        # hook: a label takes the least value any of its nodes saw; then jump to the label's own label
        hooked = low.groupBy("s", F.col("label").alias("k")).agg(F.min("low").alias("h"))
        step = relay_join(low.withColumnRenamed("label", "k"), hooked, ["s", "k"], F.col("u")).select("s", "u", F.least("low", "h").alias("label"))
        jump = step.select("s", F.col("u").alias("label"), F.col("label").alias("up"))
        state_new = store.save(relay_join(step, jump, ["s", "label"], F.col("u")).select("s", "u", F.least("label", F.coalesce("up", "label")).alias("label")), f"label-{turn}").hint("merge")
        changed = state_new.join(state.withColumnRenamed("label", "old"), ["s", "u"]).where("label <> old").limit(1).count()
        store.drop(f"label-{turn - 1}")
        state = state_new
        if not changed:
            return state.toDF(scope, "node", "component")

"""From candidate buckets to confirmed links, without expanding a bucket into
all its pairs.

Items (longs, with a size) lie in buckets; items alike share one. In each
bucket every item is compared with one *hub*, the item that meets most others
over all its buckets. A bucket is settled when its items, hub aside, are in
one component. What then remains is thinned out by the operator's own bound,
if it has one, and compared across components inside the tasks; only links
come out. Every link between items of different components that share a bucket
is thus tried.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerolens.llm.common import checkpoint, components, counted, give_back, shuffle_partitions

#: Meetings of one hub (its buckets' items, added up) that are compared in one place.
HUB_MEETINGS = 4000
#: Items of a bucket that are compared with each other in one place.
BLOCK_ITEMS = 1500
LINKS = "a long, b long"


@dataclass(frozen=True)
class Comparison:
    #: (items with further columns, their names, their schema) to the same with ``payload``
    fetch: Callable[[DataFrame, list[str], str], DataFrame]
    #: payload to what ``alike`` compares; len() of it is the item's size
    parse: Callable[[bytes], object]
    alike: Callable[[object, object], bool]
    #: whether sizes (smaller, larger) rule a pair out: in tasks, and as a column
    apart: Callable[[int, int], bool]
    apart_column: Callable[[Column, Column], Column]
    #: (rows key, item, size, component) to those that may still have a link
    thin_out: Callable[[DataFrame], DataFrame] | None = None


def _links(found: list[tuple[int, int]]) -> pa.Table:
    a, b = zip(*found, strict=True) if found else ((), ())
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _with_hubs(pairs: DataFrame, many: int, how: Comparison) -> DataFrame:
    """Those of ``many`` pairs (hub, salts, item) that are alike. A hub's members
    are dealt out by salt, the hub going to each part that has one."""
    groups = max(4 * shuffle_partitions(pairs.sparkSession), many // 2000)
    to = F.struct("hub", F.pmod(F.xxhash64("item"), "salts").cast("int").alias("salt")).alias("to")
    members = pairs.select("item", to)
    hubs = members.select("to").distinct().select(F.col("to.hub").alias("item"), "to")
    wanted = members.union(hubs).groupBy("item").agg(F.collect_list("to").alias("to"))
    held = how.fetch(wanted, ["to"], "to array<struct<hub:long,salt:int>>")
    held = held.select("item", "payload", F.explode("to").alias("to"))
    held = held.select("item", "payload", "to.hub", "to.salt", F.pmod(F.xxhash64("to"), F.lit(groups)).alias("place"))
    parse, alike = how.parse, how.alike

    def compare(table: pa.Table) -> pa.Table:
        lots: dict[tuple, dict[int, bytes]] = {}
        columns = (table.column(c).to_pylist() for c in ("hub", "salt", "item", "payload"))
        for hub, salt, item, payload in zip(*columns, strict=True):
            lots.setdefault((hub, salt), {})[item] = payload
        found = []
        for (hub, _), lot in lots.items():
            if hub in lot:
                centre = parse(lot[hub])
                found += [(hub, i) for i, p in lot.items() if i != hub and alike(centre, parse(p))]
        lots.clear()
        give_back()
        return _links(found)

    return checkpoint(held.groupBy("place").applyInArrow(compare, LINKS))


def _unsettled(entries: DataFrame) -> DataFrame:
    """Rows of buckets with several components; buckets that hold the same
    items count once."""
    open_keys = (
        entries.groupBy("key")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count("*").alias("many"),
            F.bit_xor(F.xxhash64("item")).alias("who"),
            F.bit_xor(F.xxhash64("item", F.lit(1))).alias("who_else"),
        )
        .where("low < high")
        .groupBy("many", "who", "who_else")
        .agg(F.min("key").alias("key"))
        .select("key")
    )
    return entries.join(open_keys, "key")


def _across(entries: DataFrame, how: Comparison) -> DataFrame:
    """Links between different components inside the buckets left. A bucket of
    more than ``BLOCK_ITEMS`` items is cut into blocks, and every two blocks
    meet in a place of their own, so no task holds a whole hot bucket."""
    blocks = entries.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_ITEMS).cast("int").alias("blocks"))
    own = F.pmod(F.xxhash64("item", F.lit(2)), "blocks").cast("int").alias("block")
    entries = entries.join(blocks, "key").select("key", "item", "component", "blocks", own)
    wanted = entries.groupBy("item").agg(F.collect_list(F.struct("key", "component", "blocks", "block")).alias("to"))
    held = how.fetch(wanted, ["to"], "to array<struct<key:long,component:long,blocks:int,block:int>>")
    held = held.select("item", "payload", F.explode("to").alias("to")).select("item", "payload", "to.*")
    held = held.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "item", "component", "block", "payload",
        F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
    )
    parse, alike, apart = how.parse, how.alike, how.apart

    def compare(table: pa.Table) -> pa.Table:
        columns = (table.column(c).to_pylist() for c in ("item", "component", "block", "payload"))
        held = {item: (component, parse(payload), block) for item, component, block, payload in zip(*columns, strict=True)}
        within = table.column("one")[0].as_py() == table.column("two")[0].as_py()
        parent = {component: component for component, _, _ in held.values()}

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        found = []
        by_size = sorted(held, key=lambda i: (len(held[i][1]), i))
        for i, a in enumerate(by_size):
            component, mine, block = held[a]
            for b in by_size[i + 1 :]:
                other, theirs, its = held[b]
                if apart(len(mine), len(theirs)):
                    break  # so are all larger ones
                if not within and block == its:
                    continue
                ra, rb = root(component), root(other)
                if ra != rb and alike(mine, theirs):
                    parent[max(ra, rb)] = min(ra, rb)
                    found.append((a, b))
        held.clear()
        give_back()
        return _links(found)

    return checkpoint(held.groupBy("key", "one", "two").applyInArrow(compare, LINKS))


def linked(entries: DataFrame, how: Comparison) -> DataFrame:
    """(id, component) of all items of ``entries`` (key, item, size) with a link."""
    met = entries.groupBy("key").agg(F.count("*").alias("many")).where("many > 1")
    entries = checkpoint(entries.join(met, "key"))
    popular = entries.groupBy("item").agg(F.sum("many").alias("meets"))
    hubs = (
        entries.join(popular, "item")
        .groupBy("key")
        .agg(F.max(F.struct("meets", "item", "size")).alias("hub"))
        .select(
            "key", F.col("hub.item").alias("hub"), F.col("hub.size").alias("hub_size"),
            F.ceil(F.col("hub.meets") / HUB_MEETINGS).cast("int").alias("salts"),
        )
    )
    # What a bucket holds apart from its hub, and the pairs with the hub.
    entries = checkpoint(entries.join(hubs, "key").where("item <> hub"))
    possible = ~how.apart_column(F.least("size", "hub_size"), F.greatest("size", "hub_size"))
    pairs, size = counted(entries.where(possible).select("hub", "salts", "item").distinct())
    links = _with_hubs(pairs, size["n"], how)
    joined = components(links)

    left = entries.join(joined.select(F.col("id").alias("item"), "component"), "item", "left").select(
        "key", "item", "size", F.coalesce("component", "item").alias("component")
    )
    left, size = counted(_unsettled(left))
    if how.thin_out and size["n"]:
        left, size = counted(_unsettled(how.thin_out(left)))
    if size["n"]:
        joined = components(links.union(_across(left, how)))
    return joined

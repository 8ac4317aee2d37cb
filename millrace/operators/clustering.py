"""Clusters of postings that are the same opening: complete linkage within a company.

Two clusters merge only if every pair across them matches. (Connected components would be wrong: a chain of
matches is not a match of its ends.) Matches are taken by priority, then by the rows' order.

Rows of one source match by their external id only (priority 0); anchors count across different sources, the least priority of those that two rows share. No pairs are made:

1. Rows that agree in source, external id and anchors are one node, since they match the same rows and each other.
2. Nodes that share an anchor with a node of another source, or the external id of their source, are of one connected component, found by Spark from (node, anchor) edges. Nothing merges across components.
3. Each component is merged by itself, as a stream of components in every task. It holds its nodes and anchors, not its pairs. A cluster has at most one external id of each source, so
   of the very many nodes that may share an anchor those whose cluster already has a source of the other's are passed over by arrays of bits. Two clusters are compared once: what did not match never will.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.components import connected
from millrace.sources.versions import cut

#: Candidates from which on arrays decide which are worth a look.
MANY = 32


def nodes_of(rows: DataFrame, company: str, order: str, source: str, external_id: str, anchors: str) -> tuple[DataFrame, DataFrame]:
    """The rows' keys (company, order, _key) and the nodes (_id, company, _key, _first, _source, _external, _anchors), both written."""
    own = F.when(F.col(external_id).isNull(), F.col(order))  # without an external id a row is like no other
    sorted_anchors = F.array_sort(F.array_distinct(F.coalesce(F.col(anchors), F.array().cast(dict(rows.dtypes)[anchors]))))
    keyed = rows.select(F.col(company), F.col(order), F.col(source).cast("string").alias("_source"), F.col(external_id).cast("string").alias("_external"), sorted_anchors.alias("_anchors"), own.alias("_own"))
    keyed = cut(keyed.withColumn("_key", F.to_json(F.struct("_source", "_external", "_anchors", "_own"))), "keyed")
    nodes = keyed.groupBy(company, "_key").agg(F.min(order).alias("_first"), F.any_value("_source").alias("_source"), F.any_value("_external").alias("_external"), F.any_value("_anchors").alias("_anchors"))
    return keyed.select(company, order, "_key"), cut(nodes.withColumn("_id", F.monotonically_increasing_id()), "nodes")


def _edges(nodes: DataFrame, company: str) -> DataFrame:
    """u, v: each node with the first one of its anchor (if the anchor is in several sources), and of its external id."""
    each = nodes.select(company, "_id", "_source", F.explode("_anchors").alias("_a")).select(company, "_id", "_source", "_a.kind", "_a.value")
    heads = each.groupBy(company, "kind", "value").agg(F.min("_id").alias("v"), F.min("_source").alias("_low"), F.max("_source").alias("_high")).where("_low < _high")
    shared = each.join(heads.select(company, "kind", "value", "v"), [company, "kind", "value"]).select(F.col("_id").alias("u"), "v")
    same = nodes.where("_external IS NOT NULL").select(company, "_id", "_source", "_external")
    first = same.groupBy(company, "_source", "_external").agg(F.min("_id").alias("v"))
    return shared.union(same.join(first, [company, "_source", "_external"]).select(F.col("_id").alias("u"), "v"))


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by component and order: _component, _id, _source, _external, _anchors. Gives _id with the _id of its cluster's first node."""
    at, own = None, []

    def done():
        ids = [r["_id"] for r in own]
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([ids[k] for k in merged(own)], pa.int64())], ["_id", "_head"])

    for batch in batches:
        for row in batch.to_pylist():
            if row["_component"] != at and own:
                yield done()
                own = []
            at = row["_component"]
            own.append(row)
    if own:
        yield done()


def merged(nodes: list[dict]) -> list[int]:
    """For each node of a component, in order, the place of its cluster's first node."""
    n = len(nodes)
    sources = {s: k for k, s in enumerate(dict.fromkeys(r["_source"] for r in nodes))}
    source = np.array([sources[r["_source"]] for r in nodes])
    anchors = [{(a["kind"], a["value"]) for a in r["_anchors"]} for r in nodes]
    where: dict[int, dict[tuple, list[int]]] = {}
    for k, r in enumerate(nodes):
        for a in r["_anchors"]:
            where.setdefault(a["priority"], {}).setdefault((a["kind"], a["value"]), []).append(k)
    of = np.arange(n)
    has = np.zeros((n, -(-len(sources) // 64)), np.uint64)  # the sources of each cluster, as bits in the row of its first node
    has[np.arange(n), source // 64] = np.uint64(1) << (source % 64).astype(np.uint64)
    members = [[k] for k in range(n)]
    refused: dict[int, set[int]] = {}  # clusters with a pair across them that does not match: so it stays, however they grow

    def join(a: int, b: int) -> None:
        a, b = min(a, b), max(a, b)
        of[members[b]] = a
        members[a] += members[b]
        members[b] = []
        has[a] |= has[b]
        for c in refused.pop(b, ()):
            refused[c].discard(b)
            refuse(a, c)

    def refuse(a: int, b: int) -> None:
        refused.setdefault(a, set()).add(b)
        refused.setdefault(b, set()).add(a)

    first: dict[tuple, int] = {}
    for k, r in enumerate(nodes):
        if r["_external"] is not None and (f := first.setdefault((r["_source"], r["_external"]), k)) != k:
            join(of[f], of[k])
    for priority in sorted(where):
        places = {a: np.array(p) for a, p in where[priority].items()}
        for i in range(n):
            mine = [places[a] for a in anchors[i] if a in places]
            mine = [p[np.searchsorted(p, i, "right") :] for p in mine]
            left = np.unique(np.concatenate(mine)) if len(mine) > 1 else mine[0] if mine else ()
            if not len(left):
                continue
            # The clusters of what is left, in the order of their first rows there; only that of i changes meanwhile.
            others, at = np.unique(of[left], return_index=True)
            others = others[np.argsort(at)]
            if len(others) > MANY:
                others = others[~(has[others] & has[of[i]]).any(axis=1)]
            a = int(of[i])
            for b in others.tolist():
                if a == b or b in refused.get(a, ()) or (has[a] & has[b]).any():
                    continue
                if all(anchors[x] & anchors[y] for x in members[a] for y in members[b]):
                    join(a, b)
                    a = min(a, b)
                else:
                    refuse(a, b)
    return of.tolist()


def clusters(rows: DataFrame, company: str, order: str, source: str, external_id: str, anchors: str) -> DataFrame:
    """The rows with ``cluster``: the least ``order`` of the cluster. ``order`` is a number of its own for each row of a company; ``anchors`` is array<struct<kind: string, value: string, priority: int>>."""
    keys, nodes = nodes_of(rows, company, order, source, external_id, anchors)
    parts = connected(_edges(nodes, company)).select(F.col("node").alias("_id"), F.col("component").alias("_component"))
    dealt = nodes.join(parts, "_id").select("_component", "_first", "_id", "_source", "_external", "_anchors").repartition("_component").sortWithinPartitions("_component", "_first")
    found = cut(dealt.drop("_first").mapInArrow(_merge, "_id long, _head long"), "merged")
    named = nodes.join(found, "_id", "left").withColumn("_head", F.coalesce("_head", "_id"))
    named = named.join(nodes.select(F.col("_id").alias("_head"), F.col("_first").alias("cluster")), "_head").select(company, "_key", "cluster")
    joined = keys.join(named, [company, "_key"]).select(company, order, "cluster")
    return rows.join(joined, [company, order])


def _anchor(anchors: str, field: str):
    return F.try_element_at(F.col(anchors), F.lit(1))[field]


def plain_key(source: str, external_id: str, anchors: str) -> list:
    """What the rows of a cluster agree in, in companies that ``unplain`` does not give: their anchor, or else the row's source and external id."""
    bare = F.coalesce(F.size(anchors), F.lit(0)) <= 0
    own = [F.when(bare, F.col(c)).alias(f"_bare_{k}") for k, c in enumerate((source, external_id))]
    return [_anchor(anchors, "kind").alias("_kind"), _anchor(anchors, "value").alias("_value"), *own]


def unplain(rows: DataFrame, company: str, source: str, external_id: str, anchors: str) -> DataFrame:
    """The companies where complete linkage is more than a grouping, whatever part of their rows is taken. In the others each row has a source, an external id and at most one anchor; rows that agree in
    source and external id have the same anchor; and rows that share an anchor have the same priority and only one external id in each source. There every two rows of an anchor match, and no others do.

    Values are compared by 64-bit hashes inside these groups.
    """
    at = {f: _anchor(anchors, f) for f in ("kind", "value", "priority")}
    size = F.greatest(F.coalesce(F.size(anchors), F.lit(0)), F.lit(0))
    empty = F.col(source).isNull() | F.col(external_id).isNull() | (size > 1) | ((size == 1) & (at["kind"].isNull() | at["value"].isNull() | at["priority"].isNull()))
    rows = rows.where(F.col(company).isNotNull()).select(
        F.col(company), F.col(source).cast("string").alias("_source"), F.col(external_id).cast("string").alias("_external"), *[c.alias(f"_{f}") for f, c in at.items()], empty.alias("_empty")
    )
    hashed = F.xxhash64("_kind", "_value", "_priority")
    nodes = rows.groupBy(company, "_source", "_external").agg(F.min(hashed).alias("_low"), F.max(hashed).alias("_high"), F.max("_empty").alias("_empty"))
    other = F.xxhash64("_external")
    shared = rows.where("_kind IS NOT NULL").groupBy(company, "_kind", "_value", "_source").agg(F.min(other).alias("_low"), F.max(other).alias("_high"), F.min("_priority").alias("_least"), F.max("_priority").alias("_most"))
    shared = shared.groupBy(company, "_kind", "_value").agg(F.max(F.col("_low") != F.col("_high")).alias("_differ"), F.min("_least").alias("_least"), F.max("_most").alias("_most"))
    return nodes.where("_low <> _high OR _empty").select(company).union(shared.where("_differ OR _least <> _most").select(company)).distinct()


def representative(variants: DataFrame, cluster: str, managed: str, rank: str, ties: list[str]) -> DataFrame:
    """One row of each cluster: a managed one first, then by rank, then by ``ties``. One aggregation, combined before the shuffle."""
    first = F.struct(F.when(F.col(managed), 0).otherwise(1), rank, *ties)
    return variants.groupBy(cluster).agg(F.min_by(F.struct("*"), first).alias("_row")).select("_row.*")

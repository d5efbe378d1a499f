"""Near-duplicate embeddings by range search in robust-pruned graphs over overlapping shards."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attestry.llm.components import components
from attestry.llm.flat_graph import pruned_neighbours, range_search, roots
from attestry.session import materialize

#: Bounds: vectors that centres are fitted on, vectors per shard aimed at and allowed, audited queries.
SAMPLE_VECTORS, SHARD_AIM, SHARD_MOST, AUDIT_VECTORS = 16_384, 512, 4_096, 512
LEAST_RECALL = 0.9
OVERLAPS = (2, 4, 8)
#: Audited vectors with at most so many links are also judged apart, and rows compared at once by brute force.
FEW_LINKS, BLOCK_ROWS = 8, 512


def distinct_vectors(vectors: DataFrame) -> DataFrame:
    """Valid vectors, equal ones of a label merged: node, label, dims, embedding, copies."""
    bad = F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    )
    length = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x * x)
    return (
        vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull())
        .where(~bad).where(length > 0)
        .groupBy("label", "embedding").agg(F.count(F.lit(1)).alias("copies"))
        .select(
            F.xxhash64("label", "embedding").alias("node"), "label", F.size("embedding").alias("dims"),
            "embedding", "copies",
        )
    )


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Equally long vectors as unit rows in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    rows = np.asarray(column.flatten(), dtype=np.float64).reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def fit_centres(nodes: DataFrame) -> dict[tuple, np.ndarray]:
    """Centres per (label, dims) from at most ``SAMPLE_VECTORS`` vectors, chosen by hash.

    Labels get a centre per ``SHARD_AIM`` of their vectors, and at most one per four sampled ones;
    labels that the sample lacks have one shard.
    """
    sample = nodes.select("node", "label", "dims", "embedding").orderBy(F.xxhash64("node"), "node").limit(SAMPLE_VECTORS)
    sample = materialize(sample)
    sizes = (
        nodes.groupBy("label", "dims").count()
        .join(F.broadcast(sample.select("label", "dims").distinct()), ["label", "dims"])
    )
    wanted = {(row["label"], row["dims"]): row["count"] for row in sizes.collect()}
    table = sample.toArrow()
    labels, dims = table.column("label").to_pylist(), table.column("dims").to_pylist()
    centres = {}
    for key, count in sorted(wanted.items()):
        rows = np.flatnonzero([pair == key for pair in zip(labels, dims)])
        k = min(math.ceil(count / SHARD_AIM), max(1, len(rows) // 4))
        own = _matrix(table.column("embedding").take(pa.array(rows)))
        own = own[np.lexsort(own.T)]
        middle = own[np.linspace(0, len(own) - 1, k).astype(int)]
        for _ in range(6):
            nearest = (own @ middle.T).argmax(axis=1)
            for c in range(k):
                total = own[nearest == c].sum(axis=0)
                if np.linalg.norm(total) > 0:
                    middle[c] = total / np.linalg.norm(total)
        centres[key] = middle
    return centres


def in_shards(nodes: DataFrame, centres: dict[tuple, np.ndarray], overlap: int) -> DataFrame:
    """Every vector once for each of its ``overlap`` nearest shards, all of them listed in ``cells``."""
    sent = nodes.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label, dims = batch.column("label").to_pylist(), batch.column("dims").to_pylist()
            cells: list[list[int]] = [[0]] * batch.num_rows
            groups: dict[tuple, list[int]] = {}
            for k, key in enumerate(zip(label, dims)):
                groups.setdefault(key, []).append(k)
            for key, rows in groups.items():
                middle = sent.value.get(key)
                if middle is not None:
                    near = _matrix(batch.column("embedding").take(pa.array(rows))) @ middle.T
                    for k, best in zip(rows, np.argsort(-near, axis=1, kind="stable")[:, :overlap]):
                        cells[k] = sorted(best.tolist())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.list_(pa.int32()))], names=[*batch.schema.names, "cells"]
            )

    kind = dict(nodes.dtypes)
    placed = nodes.mapInArrow(
        run, ", ".join(f"{name} {kind[name]}" for name in nodes.columns) + ", cells array<int>"
    ).withColumn("cell", F.explode("cells"))
    return in_parts(placed)


def in_parts(placed: DataFrame) -> DataFrame:
    """Shards that are still too large are cut by hash; their parts are searched against each other."""
    sizes = placed.groupBy("label", "dims", "cell").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(SHARD_MOST)).cast("int").alias("parts")
    )
    return placed.join(sizes, ["label", "dims", "cell"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), "parts").cast("int")
    )


def _tiled(shards: DataFrame) -> DataFrame:
    """Every vector once per pair of parts that it takes part in: ``i`` asks, ``j`` is searched."""
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    tile = F.explode(F.array_distinct(F.concat(
        F.transform(others, lambda k: F.struct(F.col("part").alias("i"), k.alias("j"))),
        F.transform(others, lambda k: F.struct(k.alias("i"), F.col("part").alias("j"))),
    )))
    return shards.withColumn("tile", tile).select(
        *[x for x in shards.columns if x not in ("part", "parts")], F.col("tile.i").alias("i"), F.col("tile.j").alias("j"),
        (F.col("tile.j") == F.col("part")).alias("indexed"), (F.col("tile.i") == F.col("part")).alias("asked"),
    )


def _mark_pairs_in_two_shards(
    linked: np.ndarray, unit: np.ndarray, cells: np.ndarray, cell: int, asked: np.ndarray, index: np.ndarray, least: float
) -> None:
    """Marks in ``linked`` (asked by index) all links of vectors that also meet in another shard."""
    for other in np.unique(cells[(cells >= 0) & (cells != cell)]):
        q, x = np.flatnonzero((cells[asked] == other).any(axis=1)), np.flatnonzero((cells[index] == other).any(axis=1))
        for at in range(0, len(q) if len(x) else 0, BLOCK_ROWS):
            rows = q[at : at + BLOCK_ROWS]
            linked[np.ix_(rows, x)] |= unit[asked[rows]] @ unit[index[x]].T >= least


def adjacency(shards: DataFrame) -> DataFrame:
    """The union of the shards' pruned neighbour lists: node, neighbours."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        names = table.column("node").to_numpy()
        a, b = pruned_neighbours(_matrix(table.column("embedding")), seed=len(names))
        bounds = np.searchsorted(a, np.arange(len(names) + 1)).astype(np.int32)
        return pa.table({
            "node": pa.array(names),
            "neighbours": pa.ListArray.from_arrays(pa.array(bounds), pa.array(names[b])),
        })

    return (
        shards.select("label", "dims", "cell", "part", "node", "embedding")
        .groupBy("label", "dims", "cell", "part").applyInArrow(run, "node long, neighbours array<long>")
        .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("neighbours"))).alias("neighbours"))
    )


def linked_in_shards(shards: DataFrame, edges: DataFrame, least: float) -> DataFrame:
    """Per vector and shard: node, links (copies of linked vectors), root (a vector linked with it).

    A pair that meets in several shards counts in the first of them; such pairs are also compared
    exactly, so the first shard finds it if any does. Links themselves are not returned, so a crowd
    of near copies costs one row each.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("node")
        names, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        cell = table.column("cell")[0].as_py()
        unit = _matrix(table.column("embedding"))
        cells = np.full((len(names), OVERLAPS[-1]), -1)
        for k, row in enumerate(table.column("cells").to_pylist()):
            cells[k, : len(row)] = row
        index = np.flatnonzero(table.column("indexed").to_numpy(zero_copy_only=False))
        asked = np.flatnonzero(table.column("asked").to_numpy(zero_copy_only=False))
        place = np.full(len(names), -1)
        place[index] = np.arange(len(index))
        sources, targets = [], []
        lists = table.column("neighbours").to_pylist()
        for k in index:
            near = np.array(lists[k] or [], dtype=np.int64)
            at = np.minimum(np.searchsorted(names, near), len(names) - 1)
            at = place[at[names[at] == near]]
            at = at[at >= 0]
            sources.append(np.full(len(at), place[k]))
            targets.append(at)
        bounds = np.append(0, np.cumsum([len(x) for x in targets])).astype(np.int64)
        near = np.concatenate(targets) if targets else np.zeros(0, np.int64)
        q, x = range_search(unit[index], bounds, near, unit[asked], place[asked], least) if len(index) else (place[:0], place[:0])
        linked = np.zeros((len(asked), len(index)), dtype=bool)
        linked[q, x] = True
        _mark_pairs_in_two_shards(linked, unit, cells, cell, asked, index, least)
        q, x = np.nonzero(linked)
        q, x = asked[q], index[x]
        q, x = q[q != x], x[q != x]
        earlier = np.zeros(len(q), dtype=bool)
        for k in range(OVERLAPS[-1]):
            mine = cells[q, k]
            shared = (mine[:, None] == cells[x]).any(axis=1)
            earlier |= (mine >= 0) & (mine < cell) & shared
        root = roots(len(names), q, x)
        links = np.bincount(q[~earlier], weights=copies[x[~earlier]], minlength=len(names)).astype(np.int64)
        return pa.table({"node": pa.array(names), "links": pa.array(links), "root": pa.array(names[root])})

    tiled = _tiled(shards.join(edges, "node", "left"))
    return tiled.groupBy("label", "dims", "cell", "i", "j").applyInArrow(
        run, "node long, links long, root long"
    )


def linked_exactly(nodes: DataFrame, least: float) -> DataFrame:
    """As ``linked_in_shards``, from all pairs of a label, compared in blocks of its vectors cut by hash."""

    def run(table: pa.Table) -> pa.Table:
        names, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        unit = _matrix(table.column("embedding"))
        index = np.flatnonzero(table.column("indexed").to_numpy(zero_copy_only=False))
        asked = np.flatnonzero(table.column("asked").to_numpy(zero_copy_only=False))
        links = np.zeros(len(names), dtype=np.int64)
        root = np.arange(len(names))
        for at in range(0, len(asked), BLOCK_ROWS):
            rows = asked[at : at + BLOCK_ROWS]
            near = unit[rows] @ unit[index].T >= least
            near &= rows[:, None] != index[None, :]
            links[rows] = near @ copies[index]
            a, b = np.nonzero(near)
            root = roots(len(names), np.append(rows[a], np.arange(len(names))), np.append(index[b], root))
        return pa.table({"node": pa.array(names), "links": pa.array(links), "root": pa.array(names[root])})

    placed = nodes.select("label", "dims", F.lit(0).alias("cell"), "node", "embedding", "copies")
    return _tiled(in_parts(placed)).groupBy("label", "dims", "cell", "i", "j").applyInArrow(
        run, "node long, links long, root long"
    )


def audited_recall(nodes: DataFrame, links: DataFrame, least: float) -> float:
    """Mean share of found links of at most ``AUDIT_VECTORS`` vectors, by brute force in double.

    Every vector with links counts alike. The mean of those with at most ``FEW_LINKS`` is taken apart,
    and the lesser of the two returned, so a crowd does not hide that single pairs are lost.
    """
    asked = nodes.orderBy(F.xxhash64("node", F.lit(1)), "node").limit(AUDIT_VECTORS)
    table = asked.select("node", "label", "dims", "embedding").toArrow()
    if not table.num_rows:
        return 1.0
    rows: dict[tuple, list[int]] = {}
    for k, key in enumerate(zip(table.column("label").to_pylist(), table.column("dims").to_pylist())):
        rows.setdefault(key, []).append(k)
    names = table.column("node").to_numpy()
    groups = {key: (names[mine], _matrix(table.column("embedding").take(pa.array(mine)))) for key, mine in rows.items()}
    sent = nodes.sparkSession.sparkContext.broadcast(groups)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            here: dict[tuple, list[int]] = {}
            for k, key in enumerate(zip(batch.column("label").to_pylist(), batch.column("dims").to_pylist())):
                if key in sent.value:
                    here.setdefault(key, []).append(k)
            for key, mine in here.items():
                queries, unit = sent.value[key]
                near = _matrix(batch.column("embedding").take(pa.array(mine))) @ unit.T >= least
                near &= np.asarray(batch.column("node"))[mine][:, None] != queries[None, :]
                weight = np.asarray(batch.column("copies"))[mine]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries), pa.array(weight @ near)], names=["node", "true_links"]
                )

    true = nodes.mapInArrow(run, "node long, true_links long").groupBy("node").agg(F.sum("true_links").alias("true_links"))
    share = F.least(F.coalesce("links", F.lit(0)) / F.col("true_links"), F.lit(1.0))
    row = true.where("true_links > 0").join(links, "node", "left").agg(
        F.avg(share), F.avg(F.when(F.col("true_links") <= FEW_LINKS, share))
    ).first()
    return min((x for x in row if x is not None), default=1.0)


def near_vectors(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """Per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows of one label (not null) with a cosine of at least ``least`` link; cosines are computed in
    double precision, so no pair below links. Equal vectors are one node with a count. Each vector
    is indexed in its nearest shards; graphs are built per shard, their neighbour lists united, and
    every vector searches its shards. Recall is audited against brute force on a bounded sample, and
    below ``LEAST_RECALL`` the search is repeated with more shards per vector, at last by comparing
    all vectors of a label in blocks. n_links counts other
    rows; component_id is the least vec_id reachable. Null, zero and non-finite vectors and rows
    without a label link with nothing and stay. A null vec_id never names a component of others, and
    such a row is kept if nothing links with it. Other columns are not read; an empty table gives an
    empty result.
    """
    # Adding zero makes -0.0 and 0.0 the same before rows are grouped and hashed.
    vectors = vectors.select(
        "vec_id", "label",
        F.transform("embedding", lambda x: x.cast("double") + F.lit(0.0)).alias("embedding"),
    )
    keyed = vectors.select("vec_id", F.xxhash64("label", "embedding").alias("node"))
    nodes = materialize(distinct_vectors(vectors))
    centres = fit_centres(nodes)
    for overlap in OVERLAPS:
        shards = materialize(in_shards(nodes, centres, overlap))
        edges = materialize(adjacency(shards))
        found = materialize(linked_in_shards(shards, edges, least))
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
        if audited_recall(nodes, links, least) >= LEAST_RECALL:
            break
    else:
        found = materialize(linked_exactly(nodes, least))
        links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    known = nodes.select("node", "copies").join(links, "node").join(joined, "node", "left").select(
        "node", "copies", "links", F.coalesce("component", "node").alias("component")
    )
    rows = materialize(keyed.join(known, "node", "left"))
    least_id = rows.where(F.col("component").isNotNull()).groupBy("component").agg(F.min("vec_id").alias("least_id"))
    named = rows.join(least_id, "component", "left").select(
        "vec_id",
        F.coalesce(F.col("links") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least_id", "vec_id").alias("component_id"),
    )
    return named.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

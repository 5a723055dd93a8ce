"""Near-duplicate embeddings by a forest of random-projection trees.

1. Equal vectors become one node, and nodes become units: a unit is a ball of nodes whose radius is
   at most half the linking angle, so that all its nodes are linked with each other by the triangle
   inequality. At first every node is a unit; then a tree without overlap brings close units
   together, and those that fit in a ball become one, again and again until that changes little. A
   group of near copies, however large, comes down to few units, in time linear in its size.
2. Many trees split the units recursively at random directions; the units near a split go to both
   sides (spill), until a cell is small. Sides are quantiles, so a cell always shrinks. A tier of
   splits is fitted on a bounded sample of every cell; all units pass it. A tree has a direction for
   each level, so what travels is a unit's number and its projections, not its vector.
3. Units that meet in a leaf are compared by vectors rounded to a byte for a component, within the
   rounding's error; the pairs that may be linked are then verified. By centre and radius, all their
   nodes are linked, or none, or it takes the nodes themselves: those pairs are opened, in blocks.
4. Links are counted per node from the sizes of linked units, and united over units.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blobframe.session import materialize

from .common import BROADCAST_ROWS
from .jaccard_join import components

COSINE = 0.95
TREES = 12
#: A cell of up to so many units is a leaf.
LEAF = 256
#: Share of a cell's units that a split sends to both sides.
SPILL = 0.12
#: Units of a cell that a tier of splits is fitted on (expected number), and levels of a tier.
SAMPLE = 4096
LEVELS = 6
#: Rows of a cell that one task routes.
CHUNK = 1 << 18
#: Nodes of a unit that one task compares with those of another.
BLOCK = 1024
#: Units are merged until a round takes away less than this share of them.
LEAST_GAIN = 0.05
#: The trees that bring close units together have numbers from here on.
MERGING = 1 << 20
#: Angles closer than this are not told apart by bounds.
SLACK = 1e-7

UNITS = "uid long, vec array<double>, radius double"
ROWS = "cell long, uid long, at array<float>"


def stacked(column: pa.ChunkedArray) -> np.ndarray:
    """The rows of a column of vectors of one length."""
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def noise(uids: np.ndarray) -> np.ndarray:
    """A tiny number per unit that tells equal projections apart."""
    mixed = uids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(11)) * (1e-9 / (1 << 53))


def directions(tree: int, size: int, levels: int) -> np.ndarray:
    """A random direction for each level of a tree, as columns."""
    made = np.random.default_rng([tree, size])
    return made.standard_normal((levels, size)).T / math.sqrt(size)


def projected(units: DataFrame, trees: list[int], levels: int) -> DataFrame:
    """``cell, uid, at``: every unit in the first cell of every tree, and where it lies at each level.

    Vectors of different lengths are never in one cell.
    """

    def run(batches):
        for batch in batches:
            uids, lists = batch.column("uid").to_numpy(), batch.column("vec")
            sizes = lists.value_lengths().to_numpy()
            for size in np.unique(sizes).tolist():
                here = np.flatnonzero(sizes == size)
                vecs = lists.take(pa.array(here)).flatten().to_numpy().reshape(len(here), size)
                for tree in trees:
                    at = (vecs @ directions(tree, size, levels)).astype(np.float32)
                    cell = np.full(len(here), below(tree, size))
                    at = pa.FixedSizeListArray.from_arrays(pa.array(at.ravel()), levels)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell), pa.array(uids[here]), at.cast(pa.list_(pa.float32()))],
                        names=["cell", "uid", "at"],
                    )

    return units.select("uid", "vec").mapInArrow(run, ROWS)


def below(cell: int, node: int) -> int:
    """The number of a cell below another one."""
    made = np.random.SeedSequence([cell & (2**64 - 1), node]).generate_state(1, np.uint64)
    return int(made.view(np.int64)[0])


def split(
    uids: np.ndarray, at: np.ndarray, low: np.ndarray, high: np.ndarray
) -> list[tuple[int, np.ndarray]]:
    """(leaf of the tier, rows there): below ``high`` goes left, from ``low`` on goes right."""
    here, jitter = {0: np.arange(len(uids))}, noise(uids)
    for level in range(round(math.log2(len(low) + 1))):
        value, parts = at[:, level].astype(np.float64) + jitter, {}
        for node, rows in here.items():
            k = (1 << level) - 1 + node
            parts[2 * node] = rows[value[rows] < high[k]]
            parts[2 * node + 1] = rows[value[rows] >= low[k]]
        here = parts
    return [(node, rows) for node, rows in here.items() if len(rows)]


def fit(uids: np.ndarray, at: np.ndarray, levels: int, spill: float) -> tuple:
    """The bounds ``low`` and ``high`` of a tier's splits, at the quantiles of the sample."""
    low, high = np.zeros((1 << levels) - 1), np.zeros((1 << levels) - 1)
    here, jitter = {0: np.arange(len(uids))}, noise(uids)
    for level in range(levels):
        value, parts = at[:, level].astype(np.float64) + jitter, {}
        for node, rows in here.items():
            k = (1 << level) - 1 + node
            if len(rows):
                low[k], high[k] = np.quantile(value[rows], [(1 - spill) / 2, (1 + spill) / 2])
            parts[2 * node] = rows[value[rows] < high[k]]
            parts[2 * node + 1] = rows[value[rows] >= low[k]]
        here = parts
    return low, high


def levels_for(count: int, leaf: int, spill: float) -> int:
    """Levels that so many units need."""
    return max(1, math.ceil(math.log(max(count, 2) / leaf) / math.log(2 / (1 + spill))))


def leaves(units: DataFrame, trees: list[int], count: int, leaf: int, spill: float, label: str) -> DataFrame:
    """``cell, uid``: the units in the leaves of the trees, cells of at most ``leaf`` of them.

    ``count`` units need so many levels; some cells a few more, so the levels come round again.
    """
    levels = levels_for(count, leaf, spill) + LEVELS
    done, tier = None, 0
    rows = materialize(projected(units, trees, levels), f"{label}_rows")
    while True:
        sizes = materialize(rows.groupBy("cell").agg(F.count("*").alias("n")), f"{label}_sizes")
        large = sizes.where(F.col("n") > leaf)
        small = rows.join(_small(large, ["cell"]), "cell", "left_anti").select("cell", "uid")
        done = small if done is None else done.union(small)
        if large.isEmpty():
            return done
        first = tier * LEVELS % (levels - LEVELS + 1)
        rows = materialize(next_tier(rows, large, first, leaf, spill, f"{label}_{tier}"), f"{label}_{tier}")
        tier += 1


def next_tier(rows: DataFrame, large: DataFrame, first: int, leaf: int, spill: float, label: str) -> DataFrame:
    """The rows of the large cells, in the cells below them, split at the levels from ``first`` on."""
    sized = rows.join(_small(large, ["cell", "n"]), "cell")
    grain = 1 << 30
    drawn = F.pmod(F.xxhash64("uid", "cell"), F.lit(grain)) < F.lit(float(SAMPLE * grain)) / F.col("n")

    def fitted(key: tuple, table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("uid").to_numpy())
        uids, at = table.column("uid").to_numpy()[order], stacked(table.column("at"))[order]
        count = table.column("n")[0].as_py()
        low, high = fit(uids, at[:, first:], min(levels_for(count, leaf, spill), LEVELS), spill)
        return pa.table({"cell": [key[0].as_py()], "low": [low], "high": [high], "n": [count]})

    model = sized.where(drawn).groupBy("cell").applyInArrow(
        fitted, "cell long, low array<double>, high array<double>, n long"
    )
    model = materialize(model, f"{label}_model")
    chunks = F.ceil(F.col("n") / CHUNK).cast("long")
    dealt = model.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)))
    chunked = sized.withColumn("chunk", F.pmod(F.xxhash64("uid"), chunks)).drop("n")

    def routed(left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.select(["cell", "uid", "at", "chunk"])
        if not len(left) or not len(right):
            return left.slice(0, 0).drop_columns(["chunk"])
        cell = left.column("cell")[0].as_py()
        low, high = (right.column(c)[0].values.to_numpy() for c in ("low", "high"))
        parts, cells = [], []
        at = stacked(left.column("at"))[:, first:]
        for node, found in split(left.column("uid").to_numpy(), at, low, high):
            parts.append(found)
            cells.append(np.full(len(found), below(cell, node)))
        out = left.take(pa.array(np.concatenate(parts))).drop_columns(["chunk", "cell"])
        return out.add_column(0, "cell", pa.array(np.concatenate(cells)))

    keys = ["cell", "chunk"]
    return chunked.groupBy(keys).cogroup(dealt.groupBy(keys)).applyInArrow(routed, ROWS)


def _small(stored: DataFrame, columns: list[str]) -> DataFrame:
    few = stored.count() <= BROADCAST_ROWS
    return F.broadcast(stored.select(columns)) if few else stored.select(columns)


def angles(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(one @ other.T, -1.0, 1.0))


def balls(vecs: np.ndarray, radius: np.ndarray, most: float) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """Disjoint balls of radius ``most`` or less around two or more units: (units, centre, radius)."""
    near = angles(vecs, vecs) <= 2 * most
    free, found = np.ones(len(vecs), bool), []
    for pivot in np.argsort(-near.sum(1), kind="stable"):
        group = np.flatnonzero(near[pivot] & free) if free[pivot] else []
        if len(group) < 2:
            continue
        centre = vecs[group].sum(0)
        length = np.linalg.norm(centre)
        if length == 0:
            continue
        centre /= length
        reach = angles(vecs[group], centre[None])[:, 0] + radius[group]
        inside = reach <= most
        if inside.sum() < 2:
            continue
        found.append((group[inside], centre, float(reach[inside].max())))
        free[group[inside]] = False
    return found


def merged_units(
    units: DataFrame, count: int, most: float, leaf: int, turn: int
) -> tuple[DataFrame, DataFrame]:
    """One round: (units, pairs uid and parent of those that went into another unit)."""
    label = f"merge_{turn}"
    met = leaves(units, [MERGING + turn], count, leaf, 0.0, label).join(units, "uid")

    def merge(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("uid").to_numpy())
        uids, vecs = table.column("uid").to_numpy()[order], stacked(table.column("vec"))[order]
        radius = table.column("radius").to_numpy()[order]
        found = balls(vecs, radius, most)
        uid = [u for group, _, _ in found for u in uids[group].tolist()]
        parent = [int(uids[group[0]]) for group, _, _ in found for _ in group]
        vec = [c if k == 0 else None for group, c, _ in found for k in range(len(group))]
        size = [r for group, _, r in found for _ in group]
        return pa.table(
            {"uid": pa.array(uid, pa.int64()), "parent": pa.array(parent, pa.int64()),
             "vec": pa.array(vec, pa.list_(pa.float64())), "radius": pa.array(size, pa.float64())}
        )

    went = met.groupBy("cell").applyInArrow(
        merge, "uid long, parent long, vec array<double>, radius double"
    )
    went = materialize(went, f"{label}_went")
    new = went.where("vec is not null").select(F.col("parent").alias("uid"), "vec", "radius")
    left = units.join(_small(went.select("uid"), ["uid"]), "uid", "left_anti")
    moved = went.where("uid != parent").select("uid", "parent")
    return materialize(left.select("uid", "vec", "radius").union(new), f"{label}_units"), moved


def rounded_units(units: DataFrame) -> DataFrame:
    """``uid, radius, bytes, scale, error``: vectors as bytes times a scale, and how far that is off."""

    def run(batches):
        for batch in batches:
            rows = []
            for vec in batch.column("vec"):
                vec = vec.values.to_numpy()
                scale = np.abs(vec).max() / 127
                near = np.rint(vec / scale)
                rows.append((near.astype(np.int8).tobytes(), scale, np.linalg.norm(vec - near * scale)))
            columns = list(zip(*rows, strict=True)) or [[]] * 3
            out = batch.drop_columns(["vec"])
            for name, kind, values in zip(
                ("bytes", "scale", "error"), (pa.binary(), pa.float64(), pa.float64()), columns
            ):
                out = out.append_column(name, pa.array(values, kind))
            yield out

    return units.select("uid", "radius", "vec").mapInArrow(
        run, "uid long, radius double, bytes binary, scale double, error double"
    )


def likely_pairs(met: DataFrame, link: float) -> DataFrame:
    """``u, v``: units of one cell that may be linked, at least in part, for all that their bytes say."""

    def run(table: pa.Table) -> pa.Table:
        uids, radius = table.column("uid").to_numpy(), table.column("radius").to_numpy()
        scale, error = table.column("scale").to_numpy(), table.column("error").to_numpy()
        near = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.int8)
        near = near.reshape(len(uids), -1).astype(np.float32)
        cosine = (near @ near.T).astype(np.float64) * scale[:, None] * scale[None]
        off = error[:, None] + error[None] + error[:, None] * error[None] + SLACK + 1e-5
        reach = np.minimum(math.pi, link + radius[:, None] + radius[None])
        i, j = np.nonzero(np.triu(cosine + off >= np.cos(reach), 1))
        return pa.table({"u": np.minimum(uids[i], uids[j]), "v": np.maximum(uids[i], uids[j])})

    return met.groupBy("cell").applyInArrow(run, "u long, v long")


def verified_pairs(pairs: DataFrame, units: DataFrame, cosine: float) -> DataFrame:
    """``u, v, whole`` for pairs of units that are linked whole, or perhaps in part."""
    link = math.acos(cosine)
    for side in ("u", "v"):
        named = units.select(*(F.col(c).alias(n) for c, n in (("uid", side), ("vec", f"vec_{side}"), ("radius", f"radius_{side}"))))
        pairs = pairs.join(named, side)

    def run(batches):
        for batch in batches:
            if not len(batch):
                continue
            u, v = (batch.column(f"vec_{side}") for side in ("u", "v"))
            sums = [np.dot(a.values.to_numpy(), b.values.to_numpy()) for a, b in zip(u, v)]
            near = np.array(sums)
            reach = batch.column("radius_u").to_numpy() + batch.column("radius_v").to_numpy()
            angle = np.arccos(np.clip(near, -1.0, 1.0))
            whole = np.where(reach == 0, near >= cosine, angle + reach <= link - SLACK)
            keep = whole | ((reach > 0) & (angle - reach <= link + SLACK))
            yield pa.RecordBatch.from_pydict(
                {"u": batch.column("u"), "v": batch.column("v"), "whole": whole}
            ).filter(pa.array(keep))

    return pairs.mapInArrow(run, "u long, v long, whole boolean")


def opened(pairs: DataFrame, members: DataFrame, cosine: float) -> DataFrame:
    """``u, v, node, weight`` for pairs of units: how many rows of the other unit a node is linked with.

    members: uid, node, weight, vec, size (the nodes of its unit). Nodes are dealt into blocks, a
    task has one block of each unit, and gives sums per node rather than pairs.
    """
    chunks = F.ceil(F.col("size") / BLOCK).cast("long")
    blocked = members.withColumn("block", F.pmod(F.xxhash64("node"), chunks)).withColumn("blocks", chunks)
    blocks = blocked.select("uid", "blocks").distinct()
    for side in ("u", "v"):
        pairs = pairs.join(blocks.select(F.col("uid").alias(side), F.col("blocks").alias(f"n{side}")), side)
    grid = pairs.select("u", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nu") - 1)).alias("bu"), "nv")
    grid = grid.select("u", "v", "bu", F.explode(F.sequence(F.lit(0).cast("long"), F.col("nv") - 1)).alias("bv"))
    held = blocked.select("uid", "block", "node", "weight", "vec")
    sides = [
        grid.join(held, (F.col(side) == F.col("uid")) & (F.col(f"b{side}") == F.col("block"))).select(
            "u", "v", "bu", "bv", F.lit(side).alias("side"), "node", "weight", "vec"
        )
        for side in ("u", "v")
    ]

    def verify(table: pa.Table) -> pa.Table:
        vecs, node = stacked(table.column("vec")), table.column("node").to_numpy()
        weight, side = table.column("weight").to_numpy(), np.array(table.column("side").to_pylist())
        one, other = side == "u", side == "v"
        linked = vecs[one] @ vecs[other].T >= cosine
        nodes = np.r_[node[one], node[other]]
        sums = np.r_[linked @ weight[other], weight[one] @ linked]
        keep = sums > 0
        u, v = (np.full(keep.sum(), table.column(c)[0].as_py()) for c in ("u", "v"))
        return pa.table({"u": u, "v": v, "node": nodes[keep], "weight": sums[keep].astype(np.int64)})

    return sides[0].union(sides[1]).groupBy("u", "v", "bu", "bv").applyInArrow(
        verify, "u long, v long, node long, weight long"
    )


def nodes_of(vectors: DataFrame) -> DataFrame:
    """A row per distinct usable vector: h1, h2, weight, least, vec (of length one)."""
    usable = (
        (F.size("embedding") > 0)
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
        & F.exists("embedding", lambda x: x != 0)
    )
    grouped = vectors.where(usable).groupBy("h1", "h2").agg(
        F.count("*").alias("weight"), F.min("vec_id").alias("least"), F.first("embedding").alias("raw")
    )

    def unit(batches):
        for batch in batches:
            vecs = []
            for raw in batch.column("raw").to_pylist():
                vec = np.array(raw, np.float64)
                vec /= np.abs(vec).max()
                vecs.append(vec / np.linalg.norm(vec))
            yield batch.drop_columns(["raw"]).append_column("vec", pa.array(vecs, pa.list_(pa.float64())))

    return grouped.mapInArrow(
        unit, "h1 long, h2 long, weight long, least long, vec array<double>"
    ).withColumn("node", F.monotonically_increasing_id())


def near_duplicates(
    embeddings: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL
) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Two vectors link when their cosine, in double precision, is ``cosine`` (above 0) or more. Vectors
    that are NULL, empty, zero or hold NULL or non-finite components link with nothing, and no two of
    different lengths do. Repeated rows link with each other. Rows without an id take part, and get
    the least id of their component; kept is then false. Other columns are not looked at. An empty
    table gives an empty result.

    No link is reported that is not one. A link between different vectors can be missed only if no
    tree brings the two to one leaf; equal vectors, and those of one ball, are never missed.
    """
    link = math.acos(cosine)
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>"))
    # 0.0 and -0.0 are the same component.
    key = F.transform("embedding", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))
    rows = rows.withColumns({"h1": F.xxhash64(F.lit(1), key), "h2": F.xxhash64(F.lit(2), key)})
    nodes = materialize(nodes_of(rows), "nodes")
    units = nodes.select(F.col("node").alias("uid"), "vec", F.lit(0.0).alias("radius"))
    home = nodes.select("node", F.col("node").alias("uid"))
    count, turn = nodes.count(), 0
    while count > 1:
        units, moved = merged_units(units, count, link / 2 - SLACK, leaf, turn)
        moved = _small(moved, ["uid", "parent"])
        home = home.join(moved, "uid", "left").select("node", F.coalesce("parent", "uid").alias("uid"))
        home = materialize(home, f"home_{turn}")
        before, count, turn = count, units.count(), turn + 1
        if count > (1 - LEAST_GAIN) * before:
            break

    met = leaves(units, list(range(1, trees + 1)), count, leaf, spill, "forest")
    met = met.join(rounded_units(units), "uid")
    likely = materialize(likely_pairs(met, link).distinct(), "likely")
    pairs = materialize(verified_pairs(likely, units, cosine), "pairs")

    members = home.join(nodes.select("node", "weight", "least", "vec"), "node")
    sums = members.groupBy("uid").agg(F.sum("weight").alias("held"), F.count("*").alias("size"), F.min("least").alias("least"))
    sums = materialize(sums, "sums")
    part = pairs.where(~F.col("whole"))
    opening = part.select(F.col("u").alias("uid")).union(part.select(F.col("v").alias("uid"))).distinct()
    inside = members.join(sums.select("uid", "size"), "uid").join(_small(materialize(opening, "opening"), ["uid"]), "uid", "left_semi")
    found = materialize(opened(part, materialize(inside, "inside"), cosine), "opened")
    whole = pairs.where("whole")
    both = whole.select(F.col("u").alias("uid"), F.col("v").alias("other")).union(
        whole.select(F.col("v").alias("uid"), F.col("u").alias("other"))
    )
    beside = both.join(sums.select(F.col("uid").alias("other"), "held"), "other")
    beside = beside.groupBy("uid").agg(F.sum("held").alias("beside"))
    edges = whole.select("u", "v").union(found.select("u", "v").distinct())
    groups = components(edges, "near").withColumnsRenamed({"node": "uid", "root": "group"})
    units = sums.join(beside, "uid", "left").join(groups, "uid", "left")
    units = materialize(units.withColumn("group", F.coalesce("group", "uid")), "grouped")
    least = units.groupBy("group").agg(F.min("least").alias("component_id"))
    units = units.join(least, "group").select("uid", "held", "beside", "component_id")
    extra = found.groupBy("node").agg(F.sum("weight").alias("extra"))
    judged = home.join(units, "uid").join(extra, "node", "left").join(nodes.select("node", "h1", "h2"), "node")
    n_links = F.col("held") - 1 + F.coalesce("beside", F.lit(0)) + F.coalesce("extra", F.lit(0))
    judged = materialize(judged.select("h1", "h2", n_links.alias("n_links"), "component_id"), "judged")
    out = rows.select("vec_id", "h1", "h2").join(_small(judged, judged.columns), ["h1", "h2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), F.coalesce(component == F.col("vec_id"), F.lit(False)).alias("kept"),
    )

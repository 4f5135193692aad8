"""Near-duplicate vectors by spherical-cap filters.

A filter is a direction; it takes the vectors whose inner product with it is at least ALPHA.
The directions are products of small random codes: a vector is turned by a random rotation, cut
into blocks, and each block is compared with the codewords of its own; the sums of one product
a block are the products with all directions. List decoding walks the blocks, keeps the partial sums that can still reach ALPHA, and so finds every filter of a
vector without looking at the others. Vectors that meet in a filter are compared exactly.

ALPHA and the size of the codes follow from the number of rows and the similarity asked for: a
filter takes a fixed small number of random vectors on average, and there are so many filters
that two vectors just similar enough are expected to meet in ``MEETINGS`` of them.

Groups of close vectors are not taken apart into pairs. Equal vectors are one row. Vectors
with the same best filter form a ball if they lie within half the angle asked for around
their mean: any two of them are then similar enough. Only one row a ball enters a filter, and
two balls are compared by their centres and radii; members are looked at where those leave a
doubt. Links are added up as numbers, never listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_lake.llm.components import connected_components
from telemetry_lake.llm.tables import arrow_rows, shuffle_width, stored, table

SIMILARITY = 0.9
#: Filters that two vectors of just that similarity share, on average.
MEETINGS = 12.0
#: Independent codes that these are spread over.
CODES = 5
#: Random vectors that a filter takes, on average.
OCCUPANCY = 0.25
#: Codewords of a block at most; with more filters there are more blocks.
CODEWORDS = 1 << 14
#: Vectors of fewer numbers are filled up with zeros.
LEAST_DIM = 16
#: Keeps rounding out of conclusions about angles.
MARGIN = 1e-7
#: Rows that a task is handed at once.
ROWS = 500
SEED = 20_240_917


def _tail(alpha: np.ndarray, dim: int) -> np.ndarray:
    """Share of directions whose product with a fixed one is at least ``alpha``."""
    x = np.linspace(-1, 1, 20_001)
    density = (1 - x**2) ** ((dim - 3) / 2)
    steps = (density[1:] + density[:-1]) / 2
    above = np.concatenate([np.cumsum(steps[::-1])[::-1], [0.0]]) / steps.sum()
    return np.interp(alpha, x, above)


def meeting_share(alpha: float, similarity: float, dim: int) -> float:
    """Share of directions whose products with two vectors of this similarity are at least ``alpha``."""
    x = np.linspace(alpha, 1, 2001)[:-1]
    density = (1 - x**2) ** ((dim - 3) / 2)
    grid = np.linspace(-1, 1, 20_001)
    whole = ((1 - grid**2) ** ((dim - 3) / 2)).sum() * (grid[1] - grid[0])
    other = _tail((alpha - similarity * x) / np.sqrt((1 - similarity**2) * (1 - x**2)), dim - 1)
    return float((density * other).sum() * (x[1] - x[0]) / whole)


@dataclass(frozen=True)
class Code:
    """Product code of some blocks after a rotation."""

    rotation: np.ndarray
    blocks: tuple[np.ndarray, ...]  # codewords of each block, by columns

    @property
    def filters(self) -> int:
        return math.prod(b.shape[1] for b in self.blocks)

    def decode(self, units: np.ndarray, alpha: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, filter, product) of all products of at least ``alpha``, by row."""
        width, n = self.blocks[0].shape[0], len(units)
        turned = units @ self.rotation[: units.shape[1]]
        products = [turned[:, i * width : (i + 1) * width] @ b for i, b in enumerate(self.blocks)]
        best = np.stack([p.max(axis=1) for p in products], axis=1)
        needed = alpha - (best.sum(axis=1, keepdims=True) - best)
        row, sums, ids = np.arange(n), np.zeros(n), np.zeros(n, dtype=np.int64)
        for i, product in enumerate(products):
            of, word = np.nonzero(product >= needed[:, i : i + 1])
            value = product[of, word]
            order = np.lexsort((-value, of))
            of, word, value = of[order], word[order], value[order]
            # Rows lie four apart on one line, their values within one of it, so one search serves all.
            least = alpha - sums - best[row, i + 1 :].sum(axis=1)
            begin = np.searchsorted(of, row, "left")
            end = np.searchsorted(of * 4.0 - value, row * 4.0 - np.clip(least, -1.5, 1.5), "right")
            count = np.maximum(end - begin, 0)
            place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(begin, count)
            row = np.repeat(row, count)
            sums = np.repeat(sums, count) + value[place]
            ids = np.repeat(ids, count) * product.shape[1] + word[place]
        return row, ids, sums


@dataclass(frozen=True)
class Filters:
    """Several codes of their own rotations. The filters of one code share codewords, so two vectors meet
    in many of them or in none; those of different codes do not."""

    alpha: float
    codes: tuple[Code, ...]

    def decode(self, units: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Filters of each row, and the best of them; -1 where there is none."""
        found: list[np.ndarray] = []
        home = np.full(len(units), -1)
        words = max(b.shape[1] for c in self.codes for b in c.blocks)
        step = max(1, (1 << 20) // words)
        for begin in range(0, len(units), step):
            some = units[begin : begin + step]
            parts = [c.decode(some, self.alpha) for c in self.codes]
            row, ids, sums = (np.concatenate([p[i] + (k * self.codes[0].filters if i == 1 else 0) for k, p in enumerate(parts)]) for i in range(3))
            order = np.lexsort((ids, -sums, row))
            row, ids = row[order], ids[order]
            first = np.searchsorted(row, np.arange(len(some) + 1))
            has = np.flatnonzero(first[1:] > first[:-1])
            home[begin + has] = ids[first[has]]
            found += np.split(ids, first[1:-1])
        return found, home


@lru_cache(maxsize=4)
def filters_for(rows: int, dim: int, similarity: float) -> Filters:
    """The filters for a number of vectors of ``dim`` numbers, the same in every task."""
    wide = max(dim, LEAST_DIM)
    heights = np.linspace(0.05, 0.95, 901)
    share = min(OCCUPANCY / max(rows, 1), 1e-3)
    alpha = float(heights[int(np.argmax(_tail(heights, wide) <= share))])
    needed = MEETINGS / CODES / max(meeting_share(alpha, similarity, wide), 1e-15)
    blocks = 2
    while needed ** (1 / blocks) > CODEWORDS and blocks < wide // 8:
        blocks += 1
    width = -(-wide // blocks)
    words = max(2, math.ceil(needed ** (1 / blocks)))
    dice = np.random.default_rng(SEED + wide)
    codes = []
    for _ in range(CODES):
        rotation = np.linalg.qr(dice.standard_normal((width * blocks, width * blocks)))[0]
        made = []
        for _ in range(blocks):
            word = dice.standard_normal((width, words))
            made.append(word / np.linalg.norm(word, axis=0) / math.sqrt(blocks))
        codes.append(Code(rotation, tuple(made)))
    return Filters(alpha, tuple(codes))


def units_of(batch: pa.RecordBatch, column: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, unit vectors) per length of the vectors of a batch, in double precision."""
    lists = batch.column(column)
    offsets = lists.offsets.to_numpy()
    values = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)
    sizes = np.diff(offsets)
    out = []
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        vectors = values[offsets[rows][:, None] + np.arange(size)]
        # Scaled first, so that squares neither vanish nor overflow.
        vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
        out.append((rows, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)))
    return out


def usable(vector: str) -> Column:
    """Whether a vector has a direction: not null, not zero, all numbers finite."""
    v = F.col(vector)
    numbers = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(v.isNotNull() & numbers & F.exists(v, lambda x: x != 0), F.lit(False))


def _vectors(arrays: np.ndarray) -> pa.ListArray:
    n, size = arrays.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(arrays.ravel()))


def distinct_vectors(rows: DataFrame, vector: str) -> DataFrame:
    """(node, vector, copies, first_id): usable vectors, equal ones once. ``node`` numbers them."""
    return (
        rows.where(usable(vector))
        .groupBy(F.col(vector).alias("vector"))
        .agg(F.count("*").alias("copies"), F.min("vec_id").alias("first_id"))
        .withColumn("node", F.monotonically_increasing_id())
    )


def filtered(nodes: DataFrame, rows: int, similarity: float) -> DataFrame:
    """(node, dim, filters, home): all filters of each vector, and the best of them; vectors that
    no filter takes have none."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list = [None] * batch.num_rows
            home, dims = np.full(batch.num_rows, -1), np.zeros(batch.num_rows, dtype=np.int32)
            for places, units in units_of(batch, "vector"):
                dims[places] = units.shape[1]
                lists, home[places] = filters_for(rows, units.shape[1], similarity).decode(units)
                for place, ids in zip(places, lists, strict=True):
                    found[place] = ids
            offsets = np.cumsum([0, *(len(x) for x in found)])
            flat = np.concatenate(found) if found else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node"),
                    pa.array(dims),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat)),
                    pa.array(home, mask=home < 0),
                ],
                ["node", "dim", "filters", "home"],
            )

    return nodes.select("node", "vector").mapInArrow(
        of, "node bigint, dim int, filters array<bigint>, home bigint"
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Unit vectors of neighbouring rows with the same key, added up batch by batch."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        homes = batch.column("home").to_numpy()
        for places, units in units_of(batch, "vector"):
            order = np.argsort(homes[places], kind="stable")
            keys = homes[places][order]
            cuts = np.flatnonzero(np.diff(keys, prepend=keys[0] - 1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(cuts), units.shape[1], dtype=np.int32)),
                    pa.array(keys[cuts]),
                    _vectors(np.add.reduceat(units[order], cuts, axis=0)),
                ],
                ["dim", "home", "total"],
            )


def _centres(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The mean direction of each key, from sums in order of their keys."""
    key, total = None, None

    def record(done: list) -> Iterator[pa.RecordBatch]:
        for (dim, home), vector in done:
            length = np.linalg.norm(vector)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([home], pa.int64()), _vectors((vector / (length or 1.0))[None, :])],
                ["dim", "home", "centre"],
            )

    for batch in batches:
        done = []
        keys = zip(batch.column("dim").to_pylist(), batch.column("home").to_pylist(), strict=True)
        for k, vector in zip(keys, batch.column("total"), strict=True):
            vector = vector.values.to_numpy(zero_copy_only=False)
            if k == key:
                total = total + vector
            else:
                if key is not None:
                    done.append((key, total))
                key, total = k, vector
        yield from record(done)
    if key is not None:
        yield from record([(key, total)])


def balls(nodes: DataFrame, found: DataFrame, similarity: float) -> DataFrame:
    """(node, ball, radius): vectors that lie, with others, within half the angle around the mean of
    those that share their best filter. ``ball`` is the smallest node in it; any two vectors of a
    ball are at least as similar as asked for."""
    homes = found.where("home is not null").select("node", "dim", "home")
    shared = homes.groupBy("dim", "home").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    rows = stored(homes.join(shared, ["dim", "home"], "left_semi").join(nodes.select("node", "vector"), "node"), "balls-rows")
    width = shuffle_width(nodes.sparkSession)
    sums = rows.select("home", "vector").mapInArrow(_summed, "dim int, home bigint, total array<double>")
    centres = stored(
        sums.repartition(width, "dim", "home")
        .sortWithinPartitions("dim", "home")
        .mapInArrow(_centres, "dim int, home bigint, centre array<double>"),
        "balls-centres",
    )
    half = math.sqrt((1 + similarity) / 2) + MARGIN

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _products(batch, "vector", "centre")
            picked = near >= half
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").filter(pa.array(picked)),
                    batch.column("dim").filter(pa.array(picked)),
                    batch.column("home").filter(pa.array(picked)),
                    pa.array(np.arccos(np.clip(near[picked], -1, 1))),
                ],
                ["node", "dim", "home", "angle"],
            )

    members = stored(
        rows.join(centres, ["dim", "home"]).select("node", "dim", "home", "vector", "centre").mapInArrow(
            inside, "node bigint, dim int, home bigint, angle double"
        ),
        "balls-members",
    )
    whole = members.groupBy("dim", "home").agg(
        F.min("node").alias("ball"), (F.max("angle") + MARGIN).alias("radius"), F.count("*").alias("n")
    )
    return (
        members.join(whole.where("n > 1"), ["dim", "home"])
        .join(centres, ["dim", "home"])
        .select("node", "ball", "radius", "centre")
    )


def _products(batch: pa.RecordBatch, one: str, two: str) -> np.ndarray:
    """Cosines of two vector columns of equal lengths."""
    out = np.zeros(batch.num_rows)
    for (places, x), (_, y) in zip(units_of(batch, one), units_of(batch, two), strict=True):
        out[places] = np.einsum("ij,ij->i", x, y)
    return out


def _judged(similarity: float, one: str, two: str, keys: list[str]):
    """Keeps (keys, sure) of rows whose balls have all links (``sure``) or some: by the angle of
    the vectors ``one`` and ``two`` and the radii around them."""
    angle = math.acos(similarity)

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = _products(batch, one, two)
            radius = sum(batch.column(r).to_numpy() for r in ("radius_a", "radius_b"))
            apart = np.arccos(np.clip(near, -1, 1))
            points = radius == 0
            sure = np.where(points, near >= similarity, apart + radius <= angle - MARGIN)
            doubt = ~points & ~sure & (apart - radius <= angle + MARGIN)
            picked = pa.array(sure | doubt)
            columns = [batch.column(k).filter(picked) for k in keys]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(sure[sure | doubt])], [*keys, "sure"])

    return of


@dataclass(frozen=True)
class Links:
    """``vectors``: (node, vector), each once. ``nodes``: (node, ball, copies, first_id), ``ball`` the node
    itself outside of balls. ``edges``: (u, v) balls that have a link. ``added``: (ball, node, links) to add up, of all members of a
    ball where ``node`` is null."""

    vectors: DataFrame
    nodes: DataFrame
    edges: DataFrame
    added: DataFrame


def links(rows: DataFrame, vector: str, similarity: float = SIMILARITY) -> Links:
    spark = rows.sparkSession
    nodes = stored(distinct_vectors(rows, vector), "cap-nodes")
    count = nodes.count()
    with arrow_rows(spark, ROWS):
        found = stored(filtered(nodes, count, similarity), "cap-filters")
        in_balls = stored(balls(nodes, found, similarity), "cap-balls")
    members = stored(
        nodes.join(in_balls.select("node", "ball"), "node", "left").select(
            "node", F.coalesce("ball", "node").alias("ball"), "copies", "first_id"
        ),
        "cap-members",
    )
    # One row a ball: its centre, radius and weight.
    alone = nodes.join(in_balls.select("node"), "node", "left_anti").select(
        F.col("node").alias("ball"),
        F.col("vector").cast("array<double>").alias("centre"),
        F.lit(0.0).alias("radius"),
        F.col("copies").alias("weight"),
    )
    weights = members.groupBy("ball").agg(F.sum("copies").alias("weight"))
    centres = in_balls.where("node = ball").select("ball", "centre", "radius").join(weights, "ball")
    entities = stored(alone.unionByName(centres), "cap-entities")
    dims = found.select("node", "dim", F.explode("filters").alias("filter"))
    entries = dims.join(members.select("node", "ball"), "node").select("dim", "filter", "ball").distinct()
    crowded = stored(entries, "cap-entries")
    other = crowded.select("dim", "filter", F.col("ball").alias("b"))
    pairs = stored(
        crowded.withColumnRenamed("ball", "a").join(other, ["dim", "filter"]).where("a < b").select("a", "b").distinct(),
        "cap-pairs",
    )
    side = {x: entities.select(*[F.col(c).alias(f"{c}_{x}") for c in entities.columns]) for x in ("a", "b")}
    compared = pairs.join(side["a"], F.col("a") == F.col("ball_a")).join(side["b"], F.col("b") == F.col("ball_b"))
    with arrow_rows(spark, ROWS):
        judged = stored(
            compared.select("a", "b", "weight_a", "weight_b", "centre_a", "centre_b", "radius_a", "radius_b").mapInArrow(
                _judged(similarity, "centre_a", "centre_b", ["a", "b", "weight_a", "weight_b"]),
                "a bigint, b bigint, weight_a bigint, weight_b bigint, sure boolean",
            ),
            "cap-judged",
        )
        sure = judged.where("sure")
        none = F.lit(None).cast("bigint").alias("node")
        # A doubt is settled member by member of the first ball, then of the second.
        inside = members.join(nodes.select("node", "vector"), "node").select("node", "ball", "vector", "copies")
        ones = inside.select(F.col("node").alias("x"), F.col("ball").alias("a"), F.col("vector").alias("vector_x"), F.col("copies").alias("copies_x"))
        half = (
            judged.where("not sure").select("a", "b", "weight_b")
            .join(ones, "a")
            .join(side["b"].drop("weight_b"), F.col("b") == F.col("ball_b"))
            .select("a", "b", "x", "copies_x", "weight_b", "vector_x", "centre_b", F.lit(0.0).alias("radius_a"), "radius_b")
        )
        against = stored(
            half.mapInArrow(
                _judged(similarity, "vector_x", "centre_b", ["a", "b", "x", "copies_x", "weight_b"]),
                "a bigint, b bigint, x bigint, copies_x bigint, weight_b bigint, sure boolean",
            ),
            "cap-against",
        )
        twos = inside.select(F.col("node").alias("y"), F.col("ball").alias("b"), F.col("vector").alias("vector_y"), F.col("copies").alias("copies_y"))
        single = (
            against.where("not sure").select("a", "b", "x", "copies_x")
            .join(ones.select("x", "vector_x"), "x")
            .join(twos, "b")
            .select("a", "b", "x", "y", "copies_x", "copies_y", "vector_x", "vector_y", F.lit(0.0).alias("radius_a"), F.lit(0.0).alias("radius_b"))
        )
        met = stored(
            single.mapInArrow(
                _judged(similarity, "vector_x", "vector_y", ["a", "b", "x", "y", "copies_x", "copies_y"]),
                "a bigint, b bigint, x bigint, y bigint, copies_x bigint, copies_y bigint, sure boolean",
            ),
            "cap-met",
        )
    half_sure = against.where("sure")
    parts = [
        sure.select(F.col("a").alias("ball"), none, F.col("weight_b").alias("links")),
        sure.select(F.col("b").alias("ball"), none, F.col("weight_a").alias("links")),
        half_sure.select(F.col("a").alias("ball"), F.col("x").alias("node"), F.col("weight_b").alias("links")),
        half_sure.select(F.col("b").alias("ball"), none, F.col("copies_x").alias("links")),
        met.select(F.col("a").alias("ball"), F.col("x").alias("node"), F.col("copies_y").alias("links")),
        met.select(F.col("b").alias("ball"), F.col("y").alias("node"), F.col("copies_x").alias("links")),
    ]
    added = parts[0]
    for part in parts[1:]:
        added = added.unionByName(part)
    added = added.groupBy("ball", "node").agg(F.sum("links").alias("links"))
    edges = sure.select("a", "b").unionByName(half_sure.select("a", "b")).unionByName(met.select("a", "b"))
    edges = edges.distinct().select(F.col("a").alias("u"), F.col("b").alias("v"))
    return Links(nodes.select("node", "vector"), members, stored(edges, "cap-edges"), stored(added, "cap-added"))


def near_vectors(rows: DataFrame, vector: str = "embedding", similarity: float = SIMILARITY) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of (vec_id, vector).

    Two rows are linked if their cosine, in double precision, is at least ``similarity``; no other
    pairs are, and nearly all that are close are found (see the README for the recall).
    Vectors that are null, zero, or hold a null or a number that is not finite link with nothing, nor do
    vectors of different lengths. Repeated rows are linked rows of their own. ``component_id`` is the smallest id
    that is reachable, null only where no row of the group has an id; ``kept`` says whether it is
    the row's own. An empty table gives no rows; other columns play no part.
    """
    source = rows.select("vec_id", F.col(vector).alias("vector"))
    found = links(source, "vector", similarity)
    groups = stored(connected_components(found.edges), "cap-groups")
    placed = found.nodes.join(groups.withColumnRenamed("node", "ball"), "ball", "left").withColumn(
        "component", F.coalesce("component", "ball")
    )
    placed = stored(placed, "cap-placed")
    firsts = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    own = found.nodes.groupBy("ball").agg((F.sum("copies") - 1).alias("own"))
    of_ball = found.added.where("node is null").select("ball", F.col("links").alias("more"))
    of_node = found.added.where("node is not null").select("node", F.col("links").alias("most"))
    counted = (
        placed.join(firsts, "component")
        .join(own, "ball")
        .join(of_ball, "ball", "left")
        .join(of_node, "node", "left")
        .select(
            F.col("node"),
            "component_id",
            (F.col("own") + F.coalesce("more", F.lit(0)) + F.coalesce("most", F.lit(0))).alias("n_links"),
        )
    )
    key = F.when(usable("vector"), F.col("vector"))
    known = found.vectors.join(counted, "node").withColumnRenamed("vector", "same")
    rows = source.withColumn("key", key).join(known, F.col("key") == F.col("same"), "left")
    id_or_group = F.coalesce("component_id", "vec_id")
    return rows.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        id_or_group.alias("component_id"),
        F.col("vec_id").eqNullSafe(id_or_group).alias("kept"),
    )


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"))

"""Latent factors: training, prediction and exact top-k scoring."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tasteforge.operators.ordering import number_rows
from tasteforge.session import materialize, shared_dir

# Bounds of one scoring cell (a block of users against a block of items): what a task holds for either side, and pairs.
BLOCK_BYTES = 96 << 20
PAIRS_PER_CELL = 25_000_000
#: What a row takes in a task besides its vector, and an entry of a user's list.
ROW_BYTES = 64
ENTRY_BYTES = 28


@dataclass(frozen=True)
class AlsSettings:
    """The training parameters whose results have to be matched.

    ``seed`` is ours, since an unset one differs from process to process. ``num_blocks`` is how
    far one factor update spreads out. Start factors are drawn per block, so it is part of the
    result: None takes it from the number of ratings, never from the cluster. Blocks that would not
    fit a task are made smaller, so a number is the least there are (``set_blocks``).
    """

    rank: int = 10
    max_iter: int = 10
    reg_param: float = 0.1
    nonnegative: bool = True
    cold_start: str = "drop"
    block_size: int = 4096
    seed: int = 42
    num_blocks: int | None = None
    checkpoint_interval: int = 5


RATINGS_PER_BLOCK = 2_000_000


def blocks_for(n_ratings: int) -> int:
    """The most factor blocks for so many ratings: 10 at least, and about two million ratings in each."""
    return max(10, -(-n_ratings // RATINGS_PER_BLOCK))


# In every half step a factor travels to each block that has a rating of it, and soon to all of them: the bytes go with
# the number of blocks until an id has fewer ratings than there are blocks.
FEW_BLOCKS = 6
MOST_RATINGS_PER_BLOCK = 40_000_000


def als_blocks(n_ratings: int) -> int:
    """Factor blocks of a fit: a few, so that what is sent grows as the factors do, until a block's ratings fill a task."""
    return min(blocks_for(n_ratings), max(FEW_BLOCKS, -(-n_ratings // MOST_RATINGS_PER_BLOCK)))


# A task takes some 60 bytes a rating while it builds a block, and two tasks share an executor's heap.
RATINGS_PER_TASK = 10_000_000


def set_blocks(num_blocks: int, n_ratings: int) -> int:
    """Factor blocks of a fit whose settings name a number: more only where so few would not fit a task."""
    return max(num_blocks, -(-n_ratings // RATINGS_PER_TASK))


def fit_als(
    ratings: DataFrame,
    settings: AlsSettings = AlsSettings(),
    user_col: str = "user_index",
    item_col: str = "item_index",
    rating_col: str = "interaction_score",
    n_ratings: int | None = None,
) -> ALSModel:
    """Train explicit-feedback ALS (runs jobs). Factors are checkpointed to the shared folder on the way.

    Where the settings' blocks would not fit a task, the fit has more of them and keeps them on disk, so that the heap is
    left to those being built. ``n_ratings`` saves counting the ratings.
    """
    spark = ratings.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    n_ratings = ratings.count() if n_ratings is None else n_ratings
    blocks = set_blocks(settings.num_blocks, n_ratings) if settings.num_blocks else als_blocks(n_ratings)
    level = "DISK_ONLY" if settings.num_blocks and blocks > settings.num_blocks else "MEMORY_AND_DISK"
    als = ALS(
        rank=settings.rank,
        maxIter=settings.max_iter,
        regParam=settings.reg_param,
        nonnegative=settings.nonnegative,
        coldStartStrategy=settings.cold_start,
        blockSize=settings.block_size,
        seed=settings.seed,
        numUserBlocks=blocks,
        numItemBlocks=blocks,
        checkpointInterval=settings.checkpoint_interval,
        intermediateStorageLevel=level,
        userCol=user_col,
        itemCol=item_col,
        ratingCol=rating_col,
    )
    return als.fit(ratings)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Add ``prediction``; under the "drop" policy, pairs with an untrained user or item disappear."""
    return model.transform(pairs)


def plan_blocks(n_users: int, n_items: int, dim: int, slots: int, item_rows: int | None = None, k: int = 0) -> tuple[int, int]:
    """(user blocks, item blocks) for exact top-k scoring.

    A task holds at most ``BLOCK_BYTES`` for a block of either side, with copies of its vectors and the users' lists of ``k``.
    Beyond that, cells are only added while there are fewer than two per slot and they hold more than ``PAIRS_PER_CELL`` pairs. Every user block receives all items
    and every item block all users, so the side whose blocks cost fewer bytes so far is split further.
    """
    fits = max(1, BLOCK_BYTES // (24 * dim + ROW_BYTES))
    user_blocks = max(1, -(-n_users // max(1, BLOCK_BYTES // (24 * dim + ROW_BYTES + ENTRY_BYTES * k))))
    item_blocks = max(1, -(-n_items // min(item_rows or fits, fits)))
    wanted = min(2 * slots, -(-n_users * n_items // PAIRS_PER_CELL))
    while user_blocks * item_blocks < wanted:
        # User blocks cost their number times the items, item blocks theirs times the users; least where both cost the same.
        cheaper = n_items * user_blocks <= n_users * item_blocks
        if user_blocks < n_users and (cheaper or item_blocks >= n_items):
            user_blocks = min(max(1, n_users), user_blocks + max(1, user_blocks // 8))
        else:
            item_blocks = min(max(1, n_items), item_blocks + max(1, item_blocks // 8))
    return user_blocks, item_blocks


def replicated_bytes(n_users: int, n_items: int, dim: int, blocks: tuple[int, int], value_bytes: int = 4) -> int:
    """Bytes of vectors that ``plan_blocks`` makes the shuffle carry."""
    return value_bytes * dim * (n_users * blocks[1] + n_items * blocks[0])


def usable_vectors(df: DataFrame, vector_col: str, id_col: str, dim: int) -> DataFrame:
    """(id, vector) of rows that can be scored.

    A vector of another length raises. One with a missing, NaN or infinite component has no order among scores: its row
    takes no part, as if it had no factors.
    """
    vector = F.col(vector_col)
    checked = F.when(vector.isNull() | (F.size(vector) == dim), vector).otherwise(
        F.raise_error(F.concat(F.lit(f"a vector has not {dim} components, id "), F.col(id_col).cast("string")))
    )
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), checked.alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return rows.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite)


@dataclass
class CellCounts:
    """Cells (a block of users against a block of items) that a scoring had, and those that were scored, in how many waves."""

    cells: int = 0
    scored: int = 0
    waves: int = 0


def factor_topk(
    users: DataFrame,
    items: DataFrame,
    k: int,
    dim: int,
    vector_col: str = "features",
    id_col: str = "id",
    decimals: int | None = None,
    item_rows: int | None = None,
    counts: CellCounts | None = None,
) -> DataFrame:
    """(user, item, score, rank): the ``k`` items with the greatest dot product for each user, ties by item.

    Exact. Users and items are cut into blocks (``plan_blocks``); each cell, a block of either,
    multiplies Arrow batches as matrices. It gives at most ``k`` rows per user, never the pairs. Inside a cell, items are
    grouped into balls of close vectors and users into cones of close directions; a cone visits balls by the greatest
    product they allow, and a user stops at the first ball that cannot reach that user's k-th best score. This bound is
    never above that by norms (Cauchy-Schwarz). More than one item block is scored in waves by falling norm (``_topk_by_norm``), which
    carries that bound from block to block. See ``usable_vectors`` for odd vectors.
    Counting both sides runs two jobs; ``item_rows`` overrides the item block size, ``decimals`` rounds scores before
    they are ranked, and ``counts`` is filled with the numbers of cells.
    """
    slots = users.sparkSession.sparkContext.defaultParallelism
    n_users, n_items = users.count(), items.count()
    user_blocks, item_blocks = plan_blocks(n_users, n_items, dim, slots, item_rows, min(k, n_items))
    users, items = (usable_vectors(side, vector_col, id_col, dim) for side in (users, items))
    counts = counts or CellCounts()
    counts.cells = user_blocks * item_blocks
    score = _CellRun(k, dim, decimals, max(1000, 4 * slots), 2 * slots)
    if item_blocks > 1:
        return _topk_by_norm(users, items, score, user_blocks, item_blocks, counts)
    counts.scored, counts.waves = counts.cells, 1
    left = users.select("id", "vector", _hashed(user_blocks), F.lit(0).alias("ib"))
    right = items.select("id", "vector", _every(user_blocks), F.lit(0).alias("ib"))
    return score(left, right, user_blocks)


def _hashed(n: int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("ub")


def _every(n: int) -> Column:
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("ub")


@dataclass(frozen=True)
class _CellRun:
    """Scores cells: (id, vector, ub, ib) of users and of items to (user, item, score, rank) within a cell."""

    k: int
    dim: int
    decimals: int | None
    most_partitions: int
    wanted: int = 1

    def __call__(self, users: DataFrame, items: DataFrame, cells: int) -> DataFrame:
        # A given partition count also keeps AQE from merging cells: they are small but costly.
        partitions = max(1, min(cells, self.most_partitions))
        return (
            users.repartition(partitions, "ub", "ib")
            .groupBy("ub", "ib")
            .cogroup(items.repartition(partitions, "ub", "ib").groupBy("ub", "ib"))
            .applyInArrow(_cell_scorer(self.k, self.dim, self.decimals), "user bigint, item bigint, score double, rank int")
        )

    def merged(self, lists: DataFrame) -> DataFrame:
        best = Window.partitionBy("user").orderBy(F.col("score").desc(), F.col("item").asc())
        return lists.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= self.k)


def _topk_by_norm(
    users: DataFrame, items: DataFrame, score: _CellRun, user_blocks: int, item_blocks: int, counts: CellCounts
) -> DataFrame:
    """Exact top-k over item blocks cut by falling norm (runs jobs).

    Every user meets the block of the longest items first; the k-th best score there is the user's floor. Then blocks
    follow in waves of 1, 2, 4 ...; a user is sent to a block only if the user's norm times the longest item's in it can
    reach the floor, and a block of items only to blocks of users with such a user. Users are blocked by the item norm
    they still need, so whole cells fall away. After each wave the lists are merged and floors rise; when no user can
    reach the next wave, none can reach a later one.
    """
    norm = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))).alias("norm")
    items, n_items = number_rows(items.select("*", norm), [F.col("norm").desc(), "id"], "place")
    block = max(1, -(-n_items // item_blocks))
    items = items.select("id", "vector", "norm", F.expr(f"cast(place div {block} as int)").alias("ib"))
    longest = [r["norm"] for r in items.groupBy("ib").agg(F.max("norm").alias("norm")).orderBy("ib").collect()]
    item_blocks = len(longest)
    tops = F.split(F.lit(",".join(map(repr, longest))), ",").cast("array<double>")
    users = materialize(users.select("*", norm), "topk-users")
    slack = 0.0 if score.decimals is None else 10.0**-score.decimals

    def with_floors(frame: DataFrame, lists: DataFrame) -> DataFrame:
        full = lists.where(F.col("rank") == score.k).select(F.col("user").alias("id"), F.col("score").alias("floor"))
        return frame.join(full, "id", "left")

    # One block of items is all there is to score here, so its cells are cut further, into as many tasks as all cells would be.
    tasks = max(user_blocks, min(user_blocks * item_blocks, score.wanted))
    first = items.where("ib = 0").select("id", "vector", _every(tasks), "ib")
    lists = score(users.select("id", "vector", _hashed(tasks), F.lit(0).alias("ib")), first, tasks)
    lists = materialize(lists, "topk-lists")
    counts.scored, counts.waves = user_blocks, 1

    need = F.when(F.col("norm") > 0, F.col("floor") / F.col("norm"))
    users, n_users = number_rows(with_floors(users, lists).withColumn("need", need), [F.col("need").asc_nulls_first(), "id"], "place")
    share = max(1, -(-n_users // user_blocks))
    users = users.select("id", "vector", "norm", F.expr(f"cast(place div {share} as int)").alias("ub"))

    low, step = 1, 1
    while low < item_blocks:
        high = min(item_blocks, low + step)
        bound = lambda b: F.col("norm") * F.get(tops, b)
        # The bound is compared with some slack, as both sides of it are rounded.
        live = F.filter(
            F.sequence(F.lit(low), F.lit(high - 1)),
            lambda b: F.col("floor").isNull() | (bound(b) + F.lit(1e-9) * (F.lit(1.0) + bound(b)) + F.lit(slack) >= F.col("floor")),
        )
        left = with_floors(users, lists).select("id", "vector", "ub", F.explode(live).alias("ib"))
        cells = materialize(left.select("ub", "ib").distinct(), "live-cells")
        n_cells = cells.count()
        if not n_cells:
            break
        right = items.where(F.col("ib").between(low, high - 1)).join(cells, "ib").select("id", "vector", "ub", "ib")
        lists = materialize(score.merged(lists.union(score(left, right, n_cells))), "topk-lists")
        counts.scored, counts.waves = counts.scored + n_cells, counts.waves + 1
        low, step = high, 2 * step
    return lists


def _cell_scorer(k: int, dim: int, decimals: int | None, counted: list[int] | None = None):
    """The function run on one cell. A closure, so that tasks need numpy and Arrow only.

    ``counted`` gets the number of pairs of every product, if the function runs where it was made.
    """

    def matrix(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        ids = table["id"].to_numpy()
        vectors = table["vector"].combine_chunks()
        if isinstance(vectors, pa.ChunkedArray):
            vectors = pa.concat_arrays(vectors.chunks)
        # Single-precision vectors stay as they are and are only widened for a few rows at a time.
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        return ids, flat.reshape(len(ids), dim)

    def wide(vectors: np.ndarray) -> np.ndarray:
        return vectors.astype(np.float64)

    def lengths(vectors: np.ndarray) -> np.ndarray:
        out = np.empty(len(vectors))
        for low in range(0, len(vectors), 1 << 16):
            out[low : low + (1 << 16)] = np.linalg.norm(wide(vectors[low : low + (1 << 16)]), axis=1)
        return out

    def groups(columns: list[np.ndarray], size: int) -> list[np.ndarray]:
        """Rows in groups of at most ``size`` that lie close together: cut at quantiles of the column that varies most."""
        todo, done = [np.arange(len(columns[0]))], []
        while todo:
            rows = todo.pop()
            if len(rows) <= size:
                done.append(rows)
                continue
            widest = max(columns, key=lambda c: c[rows].std(dtype=np.float64))
            cuts = [len(rows) * i // 4 for i in (1, 2, 3)] if len(rows) > 4 * size else [len(rows) // 2]
            todo += np.split(rows[np.argpartition(widest[rows], cuts)], cuts)
        return done

    def balls_of(ids: np.ndarray, vectors: np.ndarray):
        """Items in the order of their balls, where a ball starts and ends, and its centre, radius and longest item."""
        balls = groups([*vectors.T, lengths(vectors)], 32)
        places = np.concatenate(balls)
        ends = np.cumsum([len(g) for g in balls])
        starts = np.concatenate(([0], ends[:-1]))
        del balls
        ids, vectors = ids[places], vectors[places]
        centres, radii, longest = np.empty((len(ends), dim)), np.empty(len(ends)), np.empty(len(ends))
        for low in range(0, len(ends), 2048):
            part = slice(low, low + 2048)
            first, sizes = starts[part] - starts[low], ends[part] - starts[part]
            near = wide(vectors[starts[low] : ends[part][-1]])
            longest[part] = np.maximum.reduceat(np.linalg.norm(near, axis=1), first)
            centres[part] = np.add.reduceat(near, first, axis=0) / sizes[:, None]
            radii[part] = np.maximum.reduceat(np.linalg.norm(near - np.repeat(centres[part], sizes, axis=0), axis=1), first)
        return ids, vectors, starts, ends, centres, radii, longest

    def score(users: pa.Table, items: pa.Table) -> pa.Table:
        types = (pa.int64(), pa.int64(), pa.float64(), pa.int32())
        done: list[list[pa.Array]] = [[], [], [], []]
        if users.num_rows and items.num_rows:
            user_ids, user_vectors = by_id(*matrix(users))
            *items_by_ball, centres, radii, longest = balls_of(*by_id(*matrix(items)))
            sizes = np.linalg.norm(centres, axis=1)
            reach = lengths(user_vectors)
            length = np.where(reach > 0, reach, 1.0)
            cones = groups([(c / length).astype(np.float32) for c in user_vectors.T], 256)
            for low in range(0, len(cones), 64):
                found = []
                for rows in cones[low : low + 64]:
                    near = wide(user_vectors[rows])
                    tops = best_in_balls((near / length[rows, None])[reach[rows] > 0], centres, sizes, radii, longest)
                    found.append(best_of(user_ids[rows], near, reach[rows], tops, *items_by_ball))
                for column, parts, kind in zip(done, zip(*found), types):
                    column.append(pa.array(np.concatenate(parts), type=kind))
        arrays = [pa.chunked_array(column, type=kind) for column, kind in zip(done, types)]
        return pa.table(arrays, names=["user", "item", "score", "rank"])

    def by_id(ids, vectors):
        order = np.argsort(ids, kind="stable")
        return ids[order], vectors[order]

    def best_in_balls(units, centres, size, radii, longest):
        """What no product of one of these unit vectors and an item of a ball exceeds, for each ball."""
        axis = units.sum(axis=0)
        length = np.linalg.norm(axis)
        if not length > 1e-6 * len(units):
            return longest
        axis /= length
        cos = min(1.0, (units @ axis).min())
        along = centres @ axis
        across = np.sqrt(np.maximum(size**2 - along**2, 0.0))
        # The cone's edge turned towards the centre, or the centre itself if it lies in the cone.
        cone = np.where(along >= cos * size, size, along * cos + across * np.sqrt(max(0.0, 1.0 - cos**2))) + radii
        # Never above the longest item; what cancels in the other bound is made up for by some slack.
        return np.fmin(longest, cone + 1e-6 * longest)

    def best_of(user_ids, vectors, reach, tops, item_ids, item_vectors, starts, ends):
        rounding = 0.0 if decimals is None else 10.0**-decimals
        floor = np.full(len(user_ids), -np.inf)
        held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
        order = np.argsort(-tops, kind="stable")
        at, balls = 0, 16
        while at < len(order):
            # The bound is compared with some slack, as both sides of it are rounded.
            bound = reach * tops[order[at]]
            live = np.flatnonzero(bound + 1e-9 * (1.0 + np.abs(bound)) + rounding >= floor)
            if not len(live):
                break
            run = np.concatenate([np.arange(starts[g], ends[g]) for g in order[at : at + balls]])
            scores = vectors[live] @ wide(item_vectors[run]).T
            if counted is not None:
                counted.append(scores.size)
            if decimals is not None:
                scores = np.round(scores, decimals)
            cut = floor[live]
            if scores.shape[1] > k:
                cut = np.maximum(cut, np.partition(scores, -k, axis=1)[:, -k])
            row, col = np.nonzero(scores >= cut[:, None])
            held = (
                np.concatenate((held[0], live[row])),
                np.concatenate((held[1], item_ids[run[col]])),
                np.concatenate((held[2], scores[row, col])),
            )
            held, rank = keep_best(*held)
            full = rank == k
            floor[held[0][full]] = held[2][full]
            at, balls = at + balls, min(128, 2 * balls)
        held, rank = keep_best(*held)
        return user_ids[held[0]], held[1], held[2], rank

    def keep_best(row, item, value):
        order = np.lexsort((item, -value, row))
        row, item, value = row[order], item[order], value[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row) + 1
        kept = rank <= k
        return (row[kept], item[kept], value[kept]), rank[kept]

    return score

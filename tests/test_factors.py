import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.sql import functions as F

from tasteforge.operators.factors import AlsSettings, CellCounts, _cell_scorer, als_blocks, blocks_for, factor_topk, fit_als, plan_blocks, predict, replicated_bytes
from tasteforge.operators.splits import rmse
from tasteforge.plans.train import train_and_evaluate


def frame(spark, vectors):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    return spark.createDataFrame(rows, "id BIGINT, features ARRAY<FLOAT>").repartition(3)


def brute_force(users, items, k):
    scores = np.float32(users).astype(float) @ np.float32(items).astype(float).T
    return {
        (u, i, rank + 1)
        for u in range(len(users))
        for rank, i in enumerate(sorted(range(len(items)), key=lambda i: (-round(scores[u, i], 9), i))[:k])
    }


@pytest.mark.parametrize("item_rows", [None, 40])
@pytest.mark.parametrize("scale", ["unit", "popularity"])
def test_topk_equals_brute_force(spark, item_rows, scale):
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(60, 6)), rng.normal(size=(150, 6))
    if scale == "popularity":  # norms that fall off steeply, so that the norm bound cuts in
        items *= np.geomspace(100, 0.01, 150)[:, None]
    got = factor_topk(frame(spark, users), frame(spark, items), 4, 6, decimals=9, item_rows=item_rows)
    assert {(r.user, r.item, r["rank"]) for r in got.collect()} == brute_force(users, items, 4)


def test_blocks_that_cannot_reach_a_floor_are_neither_scored_nor_sent(spark):
    rng = np.random.default_rng(7)
    users, items = rng.normal(size=(80, 4)), rng.normal(size=(400, 4)) * np.geomspace(100, 0.01, 400)[:, None]
    users[::9] *= 1000
    counts = CellCounts()
    got = factor_topk(frame(spark, users), frame(spark, items), 5, 4, decimals=9, item_rows=20, counts=counts)
    assert {(r.user, r.item, r["rank"]) for r in got.collect()} == brute_force(users, items, 5)
    assert counts.cells >= 20 and counts.scored < counts.cells / 2 and counts.waves < 6
    # Equal norms leave nothing to skip; every cell is scored, in waves of 1, 1, 2, 4, 8 ... blocks.
    even = np.eye(4)[rng.integers(0, 4, 400)] * 3.0
    got = factor_topk(frame(spark, users), frame(spark, even), 5, 4, decimals=9, item_rows=20, counts=counts)
    assert {(r.user, r.item, r["rank"]) for r in got.collect()} == brute_force(users, even, 5)
    assert counts.scored == counts.cells and counts.waves >= 5


def test_blocks_by_norm_with_ties_zeros_short_lists_and_empty_sides(spark):
    users = [[1.0, 0.0], [0.0, 0.0], [-1.0, 2.0]]
    items = [[0.0, 0.0]] * 5 + [[2.0, 0.0]] * 5 + [[-2.0, 0.0]] * 5 + [[0.0, 0.5]] * 3
    for k in (3, 7, 40):
        got = factor_topk(frame(spark, users), frame(spark, items), k, 2, item_rows=2)
        assert {(r.user, r.item, r["rank"]) for r in got.collect()} == brute_force(np.array(users), np.array(items), k)
    assert factor_topk(frame(spark, users).limit(0), frame(spark, items), 3, 2, item_rows=2).collect() == []
    assert factor_topk(frame(spark, users), frame(spark, [[float("nan"), 0.0]] * 5), 3, 2, item_rows=2).collect() == []


def test_norm_bound_cuts_across_item_runs(spark):
    rng = np.random.default_rng(5)
    users = np.abs(rng.normal(size=(20, 3)))
    items = np.abs(rng.normal(size=(9000, 3))) * np.geomspace(50, 0.001, 9000)[:, None]
    got = factor_topk(frame(spark, users), frame(spark, items), 3, 3, decimals=9)
    assert {(r.user, r.item, r["rank"]) for r in got.collect()} == brute_force(users, items, 3)


def cell(vectors):
    """Rows of a cell, in an order of no meaning."""
    order = np.random.default_rng(len(vectors)).permutation(len(vectors))
    lists = pa.array([[np.float32(x) for x in vectors[i]] for i in order], type=pa.list_(pa.float32()))
    return pa.table({"id": pa.array(order, type=pa.int64()), "vector": lists})


def test_a_cell_scores_few_pairs_where_norms_rule_nothing_out():
    """Items of one length: only their directions tell which a user needs, so the share scored falls as both sides grow."""
    rng, shares = np.random.default_rng(2), []
    for n_users, n_items in ((125, 500), (2000, 8000), (8000, 32000)):
        users, items = np.abs(rng.normal(size=(n_users, 3))), np.abs(rng.normal(size=(n_items, 3)))
        items /= np.linalg.norm(items, axis=1)[:, None]
        pairs = []
        got = _cell_scorer(4, 3, 9, pairs)(cell(users), cell(items))
        shares.append(sum(pairs) / (n_users * n_items))
        if n_users == 125:
            assert {tuple(r.values()) for r in got.select(["user", "item", "rank"]).to_pylist()} == brute_force(users, items, 4)
    assert shares[2] < shares[1] / 2 and shares[2] < 0.4


def test_a_cell_with_zeros_opposite_directions_and_copies():
    rng = np.random.default_rng(4)
    users = np.concatenate((rng.normal(size=(60, 3)), np.zeros((3, 3)), rng.normal(size=(1, 3)).repeat(40, 0) * 1e-3))
    items = np.concatenate((rng.normal(size=(300, 3)) * 1e6, -np.abs(rng.normal(size=(200, 3))), np.zeros((50, 3)), [[1.0, 2.0, 3.0]] * 100))
    for k in (1, 7, 900):
        got = _cell_scorer(k, 3, 9)(cell(users), cell(items))
        assert {tuple(r.values()) for r in got.select(["user", "item", "rank"]).to_pylist()} == brute_force(users, items, k)


def test_ties_go_to_the_smaller_item_and_short_lists_stay_short(spark):
    users, items = [[1.0, 0.0], [0.0, 0.0]], [[1.0, 0.0]] * 3
    got = factor_topk(frame(spark, users), frame(spark, items), 2, 2)
    assert {(r.user, r.item, r["rank"]) for r in got.collect()} == {(0, 0, 1), (0, 1, 2), (1, 0, 1), (1, 1, 2)}
    assert factor_topk(frame(spark, users), frame(spark, items), 9, 2).count() == 6


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """A non-negative rank-2 matrix with 60 % of its cells seen."""
    rng = np.random.default_rng(0)
    truth = rng.uniform(0.2, 2, (60, 2)) @ rng.uniform(0.2, 2, (2, 40))
    cells = [(u, i, float(truth[u, i])) for u in range(60) for i in range(40) if rng.random() < 0.6]
    path = str(tmp_path_factory.mktemp("planted") / "m")
    spark.createDataFrame(cells, "user_index INT, item_index INT, interaction_score FLOAT").write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("split", ["hash", "random"])
def test_training_beats_the_mean_and_predicts_no_negatives(spark, planted, split):
    trained = train_and_evaluate(planted, AlsSettings(rank=2, reg_param=0.01), split)
    error = trained.error.first().rmse
    spread = trained.train.agg(F.stddev_pop("interaction_score")).first()[0]
    assert error < spread / 3
    predicted = predict(trained.model, trained.test)
    assert predicted.where("prediction < 0").isEmpty()
    evaluator = RegressionEvaluator(metricName="rmse", labelCol="interaction_score", predictionCol="prediction")
    assert error == pytest.approx(evaluator.evaluate(predicted), rel=1e-9)


def test_training_repeats_and_drops_untrained_users(spark, planted):
    first, second = (fit_als(planted, AlsSettings(rank=2, max_iter=3)) for _ in range(2))
    pairs = spark.createDataFrame([(0, 0), (999, 0)], "user_index INT, item_index INT")
    one, two = predict(first, pairs).collect(), predict(second, pairs).collect()
    assert [r.user_index for r in one] == [0] and one == two


def test_topk_equals_the_models_own(spark, planted):
    model = fit_als(planted, AlsSettings(rank=3, max_iter=3))
    ours = factor_topk(model.userFactors, model.itemFactors, 5, 3)
    theirs = model.recommendForAllUsers(5).select("user_index", F.explode("recommendations").alias("r"))
    expected = {(r.user_index, r.r.item_index): r.r.rating for r in theirs.collect()}
    got = {(r.user, r.item): r.score for r in ours.collect()}
    assert got.keys() == expected.keys()
    assert all(got[pair] == pytest.approx(expected[pair], rel=1e-5) for pair in got)


def test_rmse_of_nothing_is_null(spark):
    assert rmse(spark.createDataFrame([], "y DOUBLE, p DOUBLE"), "y", "p").first().rmse is None


def test_block_plan_bounds_cells_and_bytes():
    for users, items, slots in [(10**6, 10**7, 10_000), (10**8, 10**7, 10_000), (10**9, 10**7, 10_000), (100, 50, 8), (10**8, 10, 8), (0, 5, 8), (5, 0, 8)]:
        plan = plan_blocks(users, items, 10, slots)
        assert users <= plan[0] * (64 << 20) // 80 + 1 and items <= plan[1] * (64 << 20) // 80 + 1
        assert replicated_bytes(users, items, 10, plan) <= 3 << 40
    assert plan_blocks(10**8, 10**7, 10, 10_000)[0] * plan_blocks(10**8, 10**7, 10, 10_000)[1] >= 20_000
    assert plan_blocks(100, 50, 10, 8) == (1, 1)
    # Near the least that so many cells can cost: 2 * sqrt(cells * users * items) vectors.
    for users in (10**6, 10**8):
        plan = plan_blocks(users, 10**7, 10, 10_000)
        assert replicated_bytes(users, 10**7, 10, plan) <= 1.3 * 40 * 2 * (plan[0] * plan[1] * users * 10**7) ** 0.5


@pytest.mark.parametrize("bad", [[float("nan"), 1.0], [float("inf"), 1.0]])
def test_vectors_without_order_take_no_part(spark, bad):
    items = [[1.0, 0.0], bad, [0.5, 0.0], [0.25, 0.0]]
    got = factor_topk(frame(spark, [[1.0, 1.0], bad]), frame(spark, items), 3, 2, item_rows=2)
    assert {(r.user, r.item, r["rank"]) for r in got.collect()} == {(0, 0, 1), (0, 2, 2), (0, 3, 3)}


def test_vectors_of_another_length_are_refused(spark):
    with pytest.raises(Exception, match="has not 2 components"):
        factor_topk(frame(spark, [[1.0], [1.0, 2.0, 3.0], [1.0, 0.0]]), frame(spark, [[1.0, 0.0]]), 1, 2).collect()


def test_the_model_does_not_depend_on_the_cluster(spark, planted, monkeypatch):
    """Only ratings and settings choose the blocks; the number of cores is never asked for."""
    assert blocks_for(10) == 10 and blocks_for(10**9) == 500
    lists = []
    for cores in (4, 16):
        monkeypatch.setattr(type(spark.sparkContext), "defaultParallelism", property(lambda self, n=cores: n))
        model = fit_als(planted.repartition(cores), AlsSettings(rank=2, max_iter=5))
        lists.append({r.id: np.array(r.features) for r in model.userFactors.collect()})
    assert lists[0].keys() == lists[1].keys()
    assert all(np.allclose(lists[0][u], lists[1][u], atol=1e-3) for u in lists[0])


def test_a_fit_gets_no_more_blocks_as_its_ratings_grow_until_they_fill_a_task():
    """Each factor is sent to every block, so the bytes of a half step go with the blocks."""
    sizes = [10, 3 * 10**6, 3 * 10**7, 2 * 10**8]
    assert [als_blocks(n) for n in sizes] == [6, 6, 6, 6]
    assert all(n / als_blocks(n) <= 40_000_000 and als_blocks(n) <= blocks_for(n) for n in (*sizes, 10**9, 10**11))


def test_training_uses_those_blocks(spark, planted):
    assert train_and_evaluate(planted, AlsSettings(rank=2, max_iter=1)).num_blocks == als_blocks(10)
    assert train_and_evaluate(planted, AlsSettings(rank=2, max_iter=1, num_blocks=3)).num_blocks == 3


def test_set_blocks_that_do_not_fit_a_task_are_made_smaller(spark, planted, monkeypatch):
    from tasteforge.operators import factors

    levels = []
    fit = factors.ALS.fit
    monkeypatch.setattr(factors.ALS, "fit", lambda als, df: levels.append(als.getIntermediateStorageLevel()) or fit(als, df))
    assert train_and_evaluate(planted, AlsSettings(rank=2, max_iter=1, num_blocks=4)).num_blocks == 4
    monkeypatch.setattr(factors, "RATINGS_PER_TASK", 200, raising=False)
    trained = train_and_evaluate(planted, AlsSettings(rank=2, max_iter=1, num_blocks=4), train_percent=100)
    assert trained.num_blocks == -(-planted.count() // 200) > 4
    assert levels == ["MEMORY_AND_DISK", "DISK_ONLY"]
    assert trained.model.userFactors.count() == 60


def test_what_a_cell_holds_is_bounded_by_its_plan():
    """With all copies and lists, not the vectors alone."""
    rng = np.random.default_rng(6)
    n_users, n_items, k = 60_000, 100_000, 30
    users, items = (np.abs(rng.normal(size=(n, 4))) * np.geomspace(9, 1, n)[:, None] for n in (n_users, n_items))
    tables = []
    for side in (users, items):
        lists = pa.ListArray.from_arrays(np.arange(0, side.size + 1, 4, dtype=np.int32), pa.array(side.astype(np.float32).ravel()))
        tables.append(pa.table({"id": pa.array(np.arange(len(side))), "vector": lists}))
    tracemalloc.start()
    assert _cell_scorer(k, 4, None)(*tables).num_rows == n_users * k
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    row = 24 * 4 + 64
    assert peak < n_users * (row + 28 * k) + n_items * row + (24 << 20)  # some products beside it
    for n_users, n_items, k in ((5_400_000, 7_200_000, 5), (10**8, 500, 5), (10**6, 10**7, 400)):
        blocks = plan_blocks(n_users, n_items, 4, 6, k=k)
        assert max(n_users / blocks[0] * (row + 28 * k), n_items / blocks[1] * row) <= 97 << 20

"""Trees grown together against MLlib's own, one setting at a time."""

import random

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from cardflow.operators import boosting
from cardflow.operators.metrics import confusion, f1_binary
from cardflow.plans import training

COLUMNS = ["a", "b", "c", "d"]
SETTINGS = [
    training.TreeParams(3, 0.1, 4, 3.0),
    training.TreeParams(1, 0.2, 2, 0.5),
    training.TreeParams(5, 0.05, 7, 1.7),
    training.TreeParams(2, 0.1, 1, 1.0),
]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(5)
    made = []
    for _ in range(3000):
        a, b, c, d = (draw.randrange(n) for n in (30, 12, 2, 30))
        made.append((float(draw.random() < 0.05 + 0.5 * (a > 20 and c) + 0.3 * (b in (3, 4))), a, b, c, d))
    return spark.createDataFrame(made, ["y", *COLUMNS]).repartition(5).persist()


def _mllib(rows, bins, params):
    vectors = bins.transform(rows)
    trees = GBTClassifier(
        featuresCol="_features", labelCol="y", weightCol="w", maxDepth=params.max_depth, maxIter=params.trees,
        stepSize=params.learning_rate, maxBins=32, seed=1,
    )
    weight = F.when(F.col("y") == 1, params.positive_weight).otherwise(1.0)
    return vectors, trees.fit(vectors.withColumn("w", weight))


def _margins(model, vectors):
    return [r[0][1] for r in model.transform(vectors).orderBy(*COLUMNS, "y").select("rawPrediction").collect()]


@pytest.mark.parametrize("chain", [2, 25])
def test_trees_equal_mllib(rows, chain, monkeypatch):
    monkeypatch.setattr(boosting, "TREES_A_CHAIN", chain)
    monkeypatch.setattr(boosting, "ROWS_A_TASK", 700)
    bins = training.bin_features(rows, COLUMNS)
    blocks = training._blocks(rows, bins, "y")
    assert blocks.rdd.getNumPartitions() == 5
    models = training._fit_all(blocks, SETTINGS, 1)
    for params, model in zip(SETTINGS, models, strict=True):
        vectors, expected = _mllib(rows, bins, params)
        assert model.getNumTrees == params.trees and model.treeWeights == expected.treeWeights
        assert _margins(model, vectors) == pytest.approx(_margins(expected, vectors), abs=1e-9)
        # Of splits that part a node alike, rounding may choose another one.
        assert list(model.featureImportances) == pytest.approx(list(expected.featureImportances), abs=1e-4)


def test_blocks_of_any_cut_hold_every_row(rows, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 100)
    blocks = boosting.pack(rows, "y", COLUMNS, [30] * 4)
    found = sorted(
        (float(y), *bins) for label, cells in blocks.rdd.collect() for y, bins in zip(label, cells.T.tolist(), strict=True)
    )
    assert found == sorted(tuple(r) for r in rows.collect())


def test_labels_that_are_neither_are_refused(rows):
    with pytest.raises(Exception, match="0 or 1"):
        boosting.pack(rows.withColumn("y", F.lit(0.5)), "y", COLUMNS, [30] * 4)
    with pytest.raises(ValueError, match="no rows"):
        boosting.pack(rows.filter("a < 0"), "y", COLUMNS, [30] * 4)


def test_a_search_counts_all_settings_in_the_same_passes(spark, rows, monkeypatch):
    passes = []
    counted = boosting._sum
    monkeypatch.setattr(boosting, "_sum", lambda *args: passes.append(args) or counted(*args))
    blocks = boosting.pack(rows, "y", COLUMNS, [30] * 4)
    trees = boosting.grow(blocks, SETTINGS)
    assert [len(t) for t in trees] == [s.trees for s in SETTINGS]
    # A pass a level of the deepest tree of a round, however many settings there are.
    assert len(passes) <= sum(max(s.max_depth for s in SETTINGS if s.trees > t) for t in range(7))


def test_columns_counted_together_give_the_counts_of_each(monkeypatch):
    draw = np.random.default_rng(3)
    numbers, width, rows = [30, 3, 12, 2, 30, 30], 31, 4000
    label = np.sort(draw.integers(0, 2, rows).astype(np.uint8))[::-1].copy()
    block = label, np.stack([draw.integers(0, n, rows) for n in numbers]).astype(np.uint8), draw.normal(size=(1, rows))
    counted, counts = [], boosting._counts
    monkeypatch.setattr(boosting, "_counts", lambda at, *args: counted.append(args[2]) or counts(at, *args))

    def grown():
        tree, found = boosting._Growing(0, 4, 3.0, len(numbers), width), []
        while tree.open():
            found.append(next(boosting._counted([block, block], [tree.job()], numbers, width)))
            tree.take(*(x.copy() for x in found[-1]))
        return found, len(counted)

    assert boosting._groups(numbers) == [(0, 1), (2, 3), (4, 5)]
    together, fewer = grown()
    counted.clear()
    monkeypatch.setattr(boosting, "JOINT_CELLS", 1)
    apart, all_of_them = grown()
    assert fewer < all_of_them and len(together) == len(apart)
    for one, other in zip(together, apart, strict=True):
        for a, b in zip(one, other, strict=True):
            assert np.allclose(a, b, rtol=1e-12, atol=1e-9)


def test_zeros_and_ones_of_the_root_are_counted_once(rows, monkeypatch):
    known, count = [], boosting._sum
    monkeypatch.setattr(boosting, "_sum", lambda rdd, jobs, *rest: known.append([j[-1] for j in jobs if j[5] == 0]) or count(rdd, jobs, *rest))
    blocks = boosting.pack(rows, "y", COLUMNS, [30] * 4)
    boosting.grow(blocks, [training.TreeParams(2, 0.1, 3, 2.0)])
    assert [k for k in known if k] == [[False], [True], [True]]


def _same_trees(found, expected):
    for trees, others in zip(found, expected, strict=True):
        for tree, other in zip(trees, others, strict=True):
            assert tree.column == other.column and tree.child == other.child
            assert all((a == b).all() for a, b in zip(tree.right, other.right, strict=True))
            assert tree.value == pytest.approx(other.value, abs=1e-9)
            assert [s[3] for s in tree.stats] == [s[3] for s in other.stats]


def test_rows_are_read_only_when_a_split_parts_a_class(rows, monkeypatch):
    rule = ((F.col("a") > 20) & (F.col("c") == 1)) | F.col("b").isin(3, 4)
    blocks = boosting.pack(rows.withColumn("y", rule.cast("int")), "y", COLUMNS, [30] * 4)
    monkeypatch.setattr(boosting, "MOST_CLASSES", 0)
    by_rows = boosting.grow(blocks, SETTINGS)
    passes = []
    for name in ("_sum", "_class_counts"):
        counted = getattr(boosting, name)
        monkeypatch.setattr(boosting, name, lambda *args, counted=counted: passes.append(counted) or counted(*args))
    monkeypatch.setattr(boosting, "MOST_CLASSES", 75)
    monkeypatch.setattr(boosting, "ROWS_A_CLASS", 1)
    found = boosting.grow(blocks, SETTINGS)
    # 14 trees of up to five levels ask three columns: as many passes as it takes to part by them.
    assert len(passes) <= 8
    _same_trees(found, by_rows)


def test_trees_of_too_many_classes_go_on_by_rows(rows, monkeypatch):
    blocks = boosting.pack(rows, "y", COLUMNS, [30] * 4)
    monkeypatch.setattr(boosting, "MOST_CLASSES", 0)
    by_rows = boosting.grow(blocks, SETTINGS)
    monkeypatch.setattr(boosting, "MOST_CLASSES", 300)
    monkeypatch.setattr(boosting, "ROWS_A_CLASS", 1)
    first = boosting._by_classes(blocks, SETTINGS)
    assert 0 < max(map(len, first)) < 7
    _same_trees(boosting.grow(blocks, SETTINGS), by_rows)


def test_one_label_alone_gives_trees_without_splits(rows, monkeypatch):
    monkeypatch.setattr(boosting, "ROWS_A_CLASS", 1)
    for label in (0, 1):
        blocks = boosting.pack(rows.withColumn("y", F.lit(label)), "y", COLUMNS, [30] * 4)
        (tree, _, _), *_ = boosting.grow(blocks, [training.TreeParams(3, 0.1, 3, 2.0)])
        assert tree.value == [2.0 * label - 1] and tree.asked() == set()


def test_later_rows_alike_to_all_trees_are_judged_as_one(rows):
    some = rows.withColumn("y", F.when(F.rand(1) < 0.9, F.col("y")))
    known = some.filter("y is not null")
    bins = training.bin_features(known, COLUMNS)
    blocks = training._blocks(known, bins, "y")
    grown = boosting.grow(blocks, [training.TreeParams(2, 0.1, 1, 3.0)])
    (model,) = training._models(blocks.bins, [training.TreeParams(2, 0.1, 1, 3.0)], grown, 1)
    asked = {c for tree in grown[0] for c in tree.asked()}
    assert 0 < len(asked) < 4
    fewer = training._binned(some, bins, "y", asked)
    assert fewer.count() < some.count() == fewer.agg(F.sum("_n")).first()[0]
    whole = model.transform(training._binned(some, bins, "y"))
    confused = lambda df, n=None: sorted(map(repr, confusion(df, "_label", rows=n).collect()))
    assert confused(model.transform(fewer), "_n") == confused(whole)
    assert f1_binary(model.transform(fewer), "_label", rows="_n").first() == f1_binary(whole, "_label").first()

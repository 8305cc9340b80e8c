import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from paywatch.models import boosting, fraud, isolation_forest as forest, store
from paywatch.models.boosting import BoostedTrees
from paywatch.settings import FEATURE_COLUMNS


@pytest.fixture(scope="module")
def labelled(spark):
    base = spark.range(400).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") % 10 == 0, 900.0 + F.col("id")).otherwise(F.col("id") % 37 + 1.0).alias("amount"),
        (F.col("id") % 24).alias("transaction_hour"),
        F.when(F.col("id") % 10 == 0, "fraud").otherwise("legit").alias("label"),
    )
    missing = {c: F.lit(0.0) for c in FEATURE_COLUMNS if c not in base.columns}
    return base.withColumns(missing).persist()


def test_fraud_model_learns_and_round_trips(spark, labelled, tmp_path):
    model, details = fraud.train_fraud_model(labelled, trees=3, depth=2)
    assert details["scale_pos_weight"] == 9.0 and details["target_column"] == "label"
    store.save_fraud_model(spark, model, details, str(tmp_path / "m"))
    loaded, read = store.load_fraud_model(spark, str(tmp_path / "m"))
    assert read == details
    scored = fraud.score_fraud(labelled, loaded)
    assert scored.where("fraud_probability < 0 OR fraud_probability > 1").isEmpty()
    wrong = scored.where((F.col("fraud_prediction") == 1) != (F.col("label") == "fraud")).count()
    assert wrong == 0 and scored.columns[: len(labelled.columns)] == labelled.columns


def test_fraud_model_trains_on_even_partitions(spark, labelled, monkeypatch):
    """Rows that all come in one partition are dealt out before the many jobs of the fit."""
    sizes = []

    class Seen(fraud.Pipeline):
        def fit(self, rows, params=None):
            sizes.extend(rows.rdd.mapPartitions(lambda part: [sum(1 for _ in part)]).collect())
            return super().fit(rows, params)

    monkeypatch.setattr(fraud, "Pipeline", Seen)
    _, details = fraud.train_fraud_model(labelled.coalesce(1), trees=1, depth=1)
    assert len(sizes) == spark.sparkContext.defaultParallelism and sum(sizes) == details["total_samples"] == 400
    assert max(sizes) - min(sizes) <= len(sizes)


BOOSTED = ["a", "b", "c", "d", "same"]


@pytest.fixture(scope="module")
def weighted(spark):
    rng = np.random.default_rng(3)
    a, b, c, d = rng.gamma(2, 20, 2000), rng.integers(0, 24, 2000), rng.integers(0, 2, 2000), rng.normal(0, 1, 2000)
    hit = rng.random(2000) < 1 / (1 + np.exp(-(a / 30 - 2 + np.where(b < 6, 1.5, 0) + c * d)))
    data = [(float(v), float(w), float(x), float(y), 7.0, int(z), 2.37 if z else 1.0) for v, w, x, y, z in zip(a, b, c, d, hit)]
    schema = ", ".join(f"{name} double" for name in BOOSTED) + ", _label int, _weight double"
    return spark.createDataFrame(data, schema).repartition(4).persist()


def _margins(model, rows):
    raw = vector_to_array("rawPrediction")[1]
    return {tuple(r[:4]): r[4] for r in model.transform(rows).select("a", "b", "c", "d", raw).collect()}


def test_boosted_trees_are_those_of_the_library(weighted):
    """Without drawing rows or features both fits are certain: the same trees, whatever the partitions."""
    vector = VectorAssembler(inputCols=BOOSTED, outputCol="features")
    own = fraud.Pipeline(stages=[vector, BoostedTrees(BOOSTED, 6, 6, 0.05, 1.0, 1.0, 42)]).fit(weighted)
    library = GBTClassifier(labelCol="_label", weightCol="_weight", maxIter=6, maxDepth=6, stepSize=0.05, seed=42)
    theirs = fraud.Pipeline(stages=[vector, library]).fit(weighted)
    expected = _margins(theirs, weighted)
    assert _margins(own, weighted) == pytest.approx(expected, abs=1e-9)
    assert own.stages[1].treeWeights == theirs.stages[1].treeWeights
    assert own.stages[1].featureImportances.toArray() == pytest.approx(theirs.stages[1].featureImportances.toArray(), abs=1e-2)  # equal gains
    few = fraud.Pipeline(stages=[vector, BoostedTrees(BOOSTED, 6, 6, 0.05, 1.0, 1.0, 42)]).fit(weighted.repartition(2))
    assert _margins(few, weighted) == pytest.approx(expected, abs=1e-9)


def test_boosted_trees_without_a_folder_that_all_tasks_see(weighted, monkeypatch):
    vector = VectorAssembler(inputCols=BOOSTED, outputCol="features")
    stages = [vector, BoostedTrees(BOOSTED, 1, 2, 0.05, 1.0, 1.0, 42)]
    expected = _margins(fraud.Pipeline(stages=stages).fit(weighted), weighted)
    monkeypatch.setattr(boosting, "qualified", lambda spark, path: "nowhere://none/meeting")
    assert _margins(fraud.Pipeline(stages=stages).fit(weighted), weighted) == pytest.approx(expected)


def test_fraud_fit_takes_as_many_jobs_for_many_trees(spark, labelled):
    """A job per level of every tree makes a fit of 300 trees wait most of its time."""
    counts = []
    for trees in (1, 6):
        spark.sparkContext.setJobGroup(f"fit-{trees}", "fit")
        fraud.train_fraud_model(labelled, trees=trees, depth=3)
        counts.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"fit-{trees}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert counts[0] == counts[1] > 0


def test_bins_come_from_all_rows():
    values = np.concatenate([np.arange(5000.0), np.full(50, 9000.0)])
    found, weights = boosting.condensed(values, np.ones(len(values)))
    assert len(found) <= boosting.POINTS + 1 and weights.sum() == len(values) and found[-1] == 9000.0
    shares = np.diff(np.searchsorted(values, boosting.thresholds_of(found, weights)), prepend=0)
    assert len(shares) == 31 and shares.min() > 140 and shares.max() < 175


def test_score_needs_all_features(labelled):
    with pytest.raises(ValueError, match="historical_max_amount"):
        fraud.score_fraud(labelled.drop("historical_max_amount"), None)


def test_forest_ranks_planted_outliers_first(spark, tmp_path):
    rng = np.random.default_rng(5)
    points = [(str(i), float(x), float(y)) for i, (x, y) in enumerate(rng.normal(0, 1, (800, 2)))]
    points += [("far1", 12.0, 12.0), ("far2", -15.0, 9.0)]
    data = spark.createDataFrame(points, "id string, amount double, transaction_hour double")
    features = ("amount", "transaction_hour")
    nodes, details = forest.train_isolation_forest(data, "id", features, trees=60)
    assert nodes.count() <= 60 * 511
    store.save_forest(spark, nodes, details, str(tmp_path / "f"))
    nodes, details = store.load_forest(spark, str(tmp_path / "f"))
    scored = forest.score_anomaly(data, nodes, details)
    top = [r["id"] for r in scored.orderBy(F.desc("anomaly_score")).limit(2).collect()]
    assert set(top) == {"far1", "far2"}
    flagged = scored.agg(F.avg("is_anomaly")).first()[0]
    assert 0.01 <= flagged <= 0.03
    again, same = forest.train_isolation_forest(data.repartition(5), "id", features, trees=60)
    assert same["offset"] == pytest.approx(details["offset"], abs=1e-12)


def test_average_path_length():
    assert forest.average_path(1) == 0 and forest.average_path(2) == 1
    assert float(forest.average_path(256)) == pytest.approx(10.24477, abs=1e-4)


def test_store_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        store.load_fraud_model(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError, match="Invalid"):
        store._write_details(spark, {"model_type": "gbt"}, str(tmp_path / "bad" / "version=000000000000"))
        store.load_fraud_model(spark, str(tmp_path / "bad"))


@pytest.mark.parametrize("shared", ["one", None])
def test_trees_draw_rows_that_share_an_id(spark, shared):
    rows = [(shared if i < 2000 else str(i), float(i % 50), float(i % 7)) for i in range(3000)]
    data = spark.createDataFrame(rows, "id string, amount double, transaction_hour double")
    nodes, details = forest.train_isolation_forest(data, "id", ("amount", "transaction_hour"), trees=20)
    drawn = {r["drawn"] for r in nodes.select("drawn").distinct().collect()}
    assert drawn == {256} and details["subsample"] == 256


def test_saving_leaves_former_versions(spark, rows, tmp_path):
    from paywatch.models import store
    from paywatch.models.isolation_forest import TREE_SCHEMA

    path = str(tmp_path / "forest")
    for number in range(5):
        store.save_forest(spark, spark.createDataFrame([], TREE_SCHEMA), {"model_type": "isolation_forest", "feature_columns": [], "number": number}, path)
        nodes, details = store.load_forest(spark, path)
        assert details["number"] == number and nodes.isEmpty()
    (tmp_path / "forest" / "version=000000000099" / "model").mkdir(parents=True)  # a fit that was cut off
    assert store.load_forest(spark, path)[1]["number"] == 4
    assert len(list((tmp_path / "forest").glob("version=*/details"))) == store.KEEP


def test_subsamples_are_drawn_by_compiled_code(spark):
    rows = spark.range(3000).select(F.xxhash64("id").alias("_row"), F.col("id").cast("double").alias("amount"))
    drawn = forest._subsamples(rows, ["amount"], 5, 64, 3000, 42)
    assert "lambda" not in drawn._jdf.queryExecution().executedPlan().toString()
    bound = (64 + 8 * 64**0.5 + 16) / 3000
    wanted = {
        (r["tree"], r["amount"], r["rank"])
        for r in rows.crossJoin(spark.range(5).select(F.col("id").cast("int").alias("tree")))
        .select("tree", "amount", (F.shiftrightunsigned(F.xxhash64("_row", "tree", F.lit(42)), 11) / F.lit(float(2**53))).alias("rank"))
        .collect()
        if r["rank"] <= bound
    }
    assert {tuple(r) for r in drawn.select("tree_id", "amount", "_rank").collect()} == wanted

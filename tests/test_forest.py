import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from watchledger.operators import anomalies, event_risk, source_risk
from watchledger.operators.forest import average_path, fit_forest, isolation_forest


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(7)
    pdf = pd.DataFrame({"id": range(2000), "x": rng.normal(0, 1, 2000), "y": rng.normal(0, 1, 2000)})
    pdf.loc[pdf["id"] < 20, ["x", "y"]] = rng.uniform(8, 12, (20, 2))
    return spark.createDataFrame(pdf)


def test_planted_outliers_are_found(planted):
    found = isolation_forest(planted, ["x", "y"], ["id"], 0.05).toPandas()
    assert found["iso_anomaly"].mean() == pytest.approx(0.05, abs=0.01)
    assert found.loc[found["id"] < 20, "iso_anomaly"].all()
    assert ((found["iso_score"] > 0) == (found["iso_anomaly"] == 1)).all()


def test_same_result_for_any_partitioning(planted):
    one = isolation_forest(planted.repartition(1), ["x", "y"], ["id"], 0.05).orderBy("id").toPandas()
    many = isolation_forest(planted.repartition(13), ["x", "y"], ["id"], 0.05).orderBy("id").toPandas()
    assert one.equals(many)


def test_scaling_does_not_matter(planted):
    plain = isolation_forest(planted, ["x", "y"], ["id"], 0.05).orderBy("id").toPandas()
    scaled = isolation_forest(planted.withColumn("x", F.col("x") * 64 + 3), ["x", "y"], ["id"], 0.05).orderBy("id").toPandas()
    assert (plain["iso_anomaly"] == scaled["iso_anomaly"]).mean() > 0.999


def test_trees_have_bounded_depth_and_full_samples(planted):
    forest = fit_forest(planted, ["x", "y"], ["id"])
    assert forest.path.shape == (100, 511)
    assert (forest.split >= 0).any(axis=1).all()
    assert forest.norm == pytest.approx(float(average_path(256)))


def test_average_path():
    assert average_path([1, 2]).tolist() == [0.0, 1.0]
    assert float(average_path(256)) == pytest.approx(10.2448, abs=1e-3)


def test_tiny_and_constant_input(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(5)], "id int, x double")
    assert isolation_forest(df, ["x"], ["id"], 0.1).agg(F.sum("iso_anomaly")).first()[0] == 0


def test_source_anomaly_labels(tables):
    scores = source_risk.ip_anomaly_scores(tables.incidents).toPandas()
    assert set(scores["isolation_score"]) <= {1, -1}
    assert (scores["isolation_score"] == 1).sum() >= 1
    assert ((scores["isolation_score"] * 0.6 + scores["z_score_max"] * 0.4) - scores["anomaly_score"]).abs().max() < 1e-3


def test_event_anomaly_values(tables):
    scored = event_risk.event_anomaly(tables.prepared).toPandas()
    assert set(scored["anomaly_score"]) <= {0.0, 100.0} and len(scored) == tables.incidents.count()


def test_top_event_anomalies_are_the_largest(tables):
    scored = anomalies.combined_anomalies(tables.prepared)
    top = anomalies.top_event_anomalies(tables.prepared).toPandas()
    assert len(top) == 20
    assert top["ensemble_anomaly_score"].max() == pytest.approx(scored.agg(F.max("ensemble_anomaly_score")).first()[0])

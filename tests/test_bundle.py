"""Saved models score as the fitted ones do, in batch and in a stream, and a new version is taken up between micro-batches."""

import pytest
from pyspark.sql import functions as F

from roadpulse.config import DEFAULT
from roadpulse.operators import models as M
from roadpulse.operators.boosting import BoostParams
from roadpulse.operators.bundle import BundleScorer, ModelBundle, latest_version
from roadpulse.operators.features import feature_sets, split_condition
from roadpulse.operators.state import FeatureModel
from roadpulse.registry.common import TEST_SPLIT_DATE, load_clean
from roadpulse.session import materialize
from roadpulse.streaming.streams import events_stream, incident_stream, run_scored
from tests.conftest import SF_SMALL

SMALL = M.ModelParams(gbt_iter=2, rf_trees=3, qrf_trees=3, qrf_min_instances=5, folds=2)
BOOST = BoostParams(n_estimators=2, learning_rate=0.3, max_depth=2, num_leaves=4)
COLS = ["severity_proba", "closure_proba", "duration_mean", "duration_p10", "duration_p50", "duration_p90"]


@pytest.fixture(scope="module")
def fitted(spark):
    clean = materialize(load_clean(spark, SF_SMALL), "bundle-clean")
    state = FeatureModel(DEFAULT).fit_split(clean, TEST_SPLIT_DATE)
    rows = materialize(state.transform(clean), "bundle-features")
    train, fs = rows.where(split_condition(TEST_SPLIT_DATE)), feature_sets()
    severity = M.SeverityStack(fs["severity"], params=SMALL, categories=["event_cause", "corridor"], ordered=BOOST).fit(train)
    closure = M.ClosureModel(fs["closure"], params=SMALL).fit(train, train)
    boosted = M.DurationBoost(fs["duration"], params=BOOST, max_bin=31).fit(train)
    return clean, rows, ModelBundle(state, severity, boosted, closure)


def _rows(df):
    return {r.id: [round(r[c], 9) for c in COLS] + [r.closure_needed] for r in df.collect()}


def test_stream_scores_equal_batch_scores(spark, fitted, tmp_path):
    clean, rows, bundle = fitted
    test = ~split_condition(TEST_SPLIT_DATE)
    path = str(tmp_path / "models")
    bundle.save(spark, path, 1)
    scorer = BundleScorer(spark, path, history=clean.where(~test))
    stream = incident_stream(events_stream(spark, SF_SMALL), with_keys=False).where(test)
    got = run_scored(stream, scorer, str(tmp_path / "out"))
    batch = M.score_incidents(rows.where(test), bundle.severity, bundle.duration, bundle.closure)
    want = _rows(batch)
    assert len(want) > 100 and _rows(got) == want
    assert {r.model_version for r in got.select("model_version").distinct().collect()} == {1}
    # A newer version is taken up with the next batch; saving it again replaces it.
    bundle.closure.threshold = 2.0
    for _ in range(2):
        bundle.save(spark, path, 2)
    scorer(clean.where(test).limit(5))
    assert latest_version(spark, path) == scorer.version == 2 and scorer.bundle.closure.threshold == 2.0
    assert ModelBundle.load(spark, path, 1).duration.importances() == bundle.duration.importances()


def test_unfitted_features_are_an_error(spark, fitted):
    with pytest.raises(RuntimeError, match="fitted"):
        FeatureModel(DEFAULT).transform(fitted[0])

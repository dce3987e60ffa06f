"""Models on the study's own feature table: importance, selection, curve, folds, certificate of the optimum."""

import pytest
from pyspark.sql import functions as F

from aloft.operators import features, models
from aloft.plans import catalog
from aloft.plans import study_models as sm
from aloft.sources.io import stage
from conftest import SF_SMALL


@pytest.fixture(scope="module")
def study(spark):
    return stage(catalog._study_table(spark, SF_SMALL))


def test_importance_equals_the_node_tables(spark, study):
    rows = sm.importance(spark, study).collect()
    assert len(rows) > len(sm.NUMBERS) and {r.name for r in rows} >= set(sm.NUMBERS)
    assert all(abs(r.score - r.score_of_nodes) < 1e-9 for r in rows) and abs(sum(r.score for r in rows) - 100) < 1e-9


def test_selected_slots_are_those_above_the_cutoff(spark, study):
    want = [r.name for r in sm.importance(spark, study).where(F.col("score") >= sm.CUTOFF).orderBy("idx").collect()]
    got = sm.selected(spark, study).collect()
    assert sorted(r.side for r in got) == ["test", "train"] and {r.slots for r in got} == {", ".join(want)} and {r.n_slots for r in got} == {len(want)}


def test_learning_curve_counts_and_nesting(study):
    facts = {(r.fraction, r.side): (r.n, r.n_positive) for r in sm.fraction_rows(study).collect()}
    curve = {(r.fraction, r.side): (r.tp + r.fp + r.tn + r.fn, r.tp + r.fn) for r in sm.learning_curve(study).collect()}
    assert curve == facts and len(facts) == 6 and facts[(1.0, "train")][0] > facts[(0.5, "train")][0] > facts[(0.25, "train")][0]
    rows = study.select(sm.KEY)
    small, large = (features.subsample(rows, f, sm.KEY, sm.SEED) for f in (0.25, 0.5))
    assert small.exceptAll(large).count() == 0


def test_gradient_vanishes_at_the_optimum(study):
    got = sm.gradient(study).collect()
    assert sorted(r.slot for r in got) == list(range(-1, len(got) - 1)) and max(abs(r.gradient) for r in got) < 1e-4
    train, _ = sm.train_and_test(study)
    early = models.log_loss_gradient(models.logistic(max_iter=1).fit(train), train)
    assert early.agg(F.max(F.abs("gradient"))).first()[0] > 1e-3


def test_folds_do_not_depend_on_the_layout(study):
    train, _ = sm.train_and_test(study)
    for n in (2, 7):
        folds = models.with_folds(train.repartition(n), sm.KEY).select(sm.KEY, "fold")
        assert folds.exceptAll(models.with_folds(train, sm.KEY).select(sm.KEY, "fold")).count() == 0
    got = sm.tuned(study).collect()
    per_fold = {}
    for r in got:
        if r.side.startswith("fold"):
            per_fold.setdefault(r.regParam, []).append(r.tp + r.fp + r.tn + r.fn)
    assert set(per_fold) == {0.0, 1.0} and all(len(v) == 3 and sum(v) == train.count() for v in per_fold.values())


def test_curve_areas(study):
    got = {(r.model, r.side): r for r in sm.curve_areas(study).collect()}
    assert len(got) == 4 and all(0 <= r.roc_auc < 1 + 1e-9 and 0 <= r.average_precision < 1 + 1e-9 for r in got.values())
    assert got["forest", "train"].roc_auc > 0.8

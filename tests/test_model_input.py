"""Fits read written features, not the source and its hashes on every pass."""

from aloft.operators import features, models
from aloft.plans import catalog
from conftest import SF_SMALL


def _written(df):
    files = df.inputFiles()
    return bool(files) and all("/aloft-stage-" in f for f in files)


def test_train_side_is_written(spark):
    train, test = catalog._model_input(spark, SF_SMALL)
    assert _written(train) and features.feature_names(train) == features.feature_names(test) != []
    rows = catalog._model_rows(spark, SF_SMALL)
    want, _ = features.split(rows, catalog._KEY, 80, seed=7)
    got = train.select(*catalog._KEY, "label")
    assert got.exceptAll(want.select(*got.columns)).count() == 0 and got.count() == want.count() < rows.count()


def test_learning_curve_fits_written_features(spark):
    seen = []

    class Spy:
        def fit(self, df):
            seen.append((_written(df), df.count()))
            return models.logistic(max_iter=3).fit(df)

    rows = catalog._model_rows(spark, SF_SMALL)
    c = models.learning_curve(rows, "label", catalog._NUM, catalog._KEY, catalog._CAT, make_estimator=Spy, seed=7).collect()
    assert [w for w, _ in seen] == [True] * 3
    assert [n + r.n_test for (_, n), r in zip(seen, c, strict=True)] == [features.subsample(rows, f, catalog._KEY, 7).count() for f in (1.0, 0.5, 0.25)]

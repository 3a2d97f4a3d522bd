from __future__ import annotations

import inspect

import pytest

from delaylake.learning import classifier_estimators
from delaylake.learning.models import regressor_estimators
from delaylake.plans.queries import QUERIES
from delaylake.plans.queries import learning as module

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "query, models", [("trained_classifiers", classifier_estimators), ("trained_regressors", regressor_estimators)]
)
def test_all_models_are_trained(spark, monkeypatch, query, models):
    """The queries hand over no estimators of their own, so the library's four are fitted."""
    seen = {}

    def fit(df, key, *features, estimators=None):
        seen["estimators"] = estimators
        return []

    monkeypatch.setattr(module, "train_classifiers" if query == "trained_classifiers" else "train_regressors", fit)
    QUERIES[query](spark, SF)
    assert seen["estimators"] is None and len(models()) == 4


def test_scoring_uses_the_librarys_logistic_setting():
    assert classifier_estimators()["LogisticRegression"].getMaxIter() == 500
    assert "maxIter" not in inspect.getsource(module)

"""The registered searches do the tuning operator's own job; only their trials are few."""

import pytest
from fixture_queries import QUERIES, models
from tallyroute.operators import boosting, model
from tallyroute.plans import student

SF = "/root/testdata/sf0.001"


class Called(Exception):
    pass


@pytest.mark.parametrize("name", ["tuned_trials", "tuned_separable", "trained_metadata"])
def test_searches_the_whole_space(spark, monkeypatch, name):
    def called(*_, **given):
        raise Called(given)

    monkeypatch.setattr(model, "tune", called)
    if name == "trained_metadata":
        monkeypatch.setattr(student, "train", called)
    with pytest.raises(Called) as found:
        QUERIES[name](spark, SF)
    assert found.value.args[0] == {"trials": 2}


def test_metadata_reads_every_parameter(spark, monkeypatch):
    monkeypatch.setattr(model, "SEARCH_SPACE", {**model.SEARCH_SPACE, "n_estimators": boosting.whole(2, 2), "max_depth": boosting.whole(3, 3)})
    monkeypatch.setitem(models.SPACE_BOUNDS, "n_estimators", (2, 2))
    row = QUERIES["trained_metadata"](spark, SF).first()
    assert row.params_in_space and row.stopped_within and row.threshold_on_grid

"""Every applicant gets a score, from a model with the default number of trees."""

from pathlib import Path

import pytest

from ledgerline.operators import default_model
from ledgerline.plans import reports
from ledgerline.plans.mapping import view

DATA = Path("/root/testdata/sf0.001")


@pytest.mark.skipif(not DATA.exists(), reason="needs the test tables")
def test_all_applicants_are_scored(spark, monkeypatch):
    asked = []
    train = default_model.train_model

    def noted(*args, **options):
        asked.append(options)
        return train(*args, **options | {"trees": 2})  # what was asked for is looked at; two are enough for the rows

    monkeypatch.setattr(default_model, "train_model", noted)
    out = reports.score_population(spark, str(DATA))
    want = {r[0] for r in view(spark, str(DATA), "application").select("SK_ID_CURR").collect()}
    got = [r.SK_ID_CURR for r in out.where("score between 0 and 1").collect()]
    assert len(got) == len(want) and set(got) == want
    assert all("trees" not in x for x in asked) and asked

"""The text comparison counts each text once and leaves a model that takes texts."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.q_models import TEXT_POLICY
from costlake.operators import encode, metrics, models, text
from costlake.plans import training


def test_texts_are_counted_before_the_rows_are_kept(spark, monkeypatch):
    ready, fit, seen = fx.ready_documents(spark, "/root/testdata/sf0.001"), models.fit_stages, []

    def spying(stages, train):
        seen.append(train)
        return fit(stages, train)

    monkeypatch.setattr(models, "fit_stages", spying)
    compared = training.compare_with_text(ready, TEXT_POLICY, fx.JOB_TABLE, text_features=64)
    assert len(seen) == 2 and not any(c in train.columns for train in seen for c in ("description", "description_tokens", "description_words"))
    # the model takes rows with texts, and a chain fitted on the texts as one has the same scores
    rows = training.training_rows(ready, TEXT_POLICY, fx.JOB_TABLE)
    stages, encoded = encode.structured_stages(["zone", "category"], ["permit_creation_year"])
    words, weighted = text.hashed_tfidf_stages("description", 64)
    whole = fit([*stages, *words, encode.assembler([*encoded, weighted]), models.ridge_log_cost(penalty=0.05)], rows.filter("split = 'train'"))
    assert isinstance(compared.models["structured_text"], PipelineModel)
    held_out = rows.filter("split <> 'train'")
    errors = [{r["split"]: r["log_rmse"] for r in metrics.log_metrics(m.transform(held_out), "label", "prediction", ["split"]).collect()}
              for m in (compared.models["structured_text"], whole)]
    assert errors[0] == pytest.approx(errors[1], rel=1e-6)
    measured = compared.metrics.filter(F.col("model") == "structured_text").select("split", "log_rmse").collect()
    assert {r["split"]: r["log_rmse"] for r in measured} == pytest.approx(errors[0], rel=1e-9)

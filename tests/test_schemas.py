"""The declared metric columns are those the metric frames have."""

import pytest

from sightline.plans import visibility_queries as v
from sightline.plans.bindings import Inputs
from sightline.schemas import METRIC_CONTEXT, METRIC_FACTS
from sightline.session import configure


@pytest.mark.parametrize("channel", ["serp", "llm", "comparison"])
def test_metric_columns(spark, channel):
    inputs = Inputs(configure(spark), "/root/testdata/sf0.001")
    frames = {"serp": v.serp_gold, "llm": v.answer_gold, "comparison": v.comparison_gold}
    assert set(frames[channel](inputs).columns) == {*METRIC_FACTS[channel], *METRIC_CONTEXT[channel]}

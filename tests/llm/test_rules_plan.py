"""The quartiles of the quality rules are counted once, not once per kind of band."""

from __future__ import annotations

import public_tokenizers

from tapflow.llm import rules


def test_quartiles_are_read_not_planned_again(spark):
    docs = spark.createDataFrame([(i, "plain words of a text that is long enough to be kept " * (2 + i % 3), "en" if i % 2 else None, "web") for i in range(60)], "doc_id long, text string, lang string, source string")
    got = rules.quality_rules(docs, public_tokenizers.path("piece_bpe_32k.model"))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The groups alone are made distinct in this plan.
    assert plan.count("HashAggregate") <= 2 and "Window" not in plan
    assert got.count() == 60

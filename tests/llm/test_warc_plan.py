from __future__ import annotations

import re

from test_warc import EDGES, pages_of

from meterline import session
from meterline.llm import warc


def test_first_pages_are_written_before_payloads_are_joined(spark, folder, monkeypatch):
    """Only a join of plain exchanges can be split; an aggregate below it cannot."""
    labels, materialised = [], session.materialised
    monkeypatch.setattr(session, "materialised", lambda df, label: (labels.append(label), materialised(df, label))[1])
    rows = warc.decide(pages_of(spark, EDGES))
    assert "first" in labels
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and not re.search("Aggregate", plan)

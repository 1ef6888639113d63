from __future__ import annotations

import pytest

from riskrank.llm.shipping import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)

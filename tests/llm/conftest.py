from __future__ import annotations

import pytest

from larder.llm.registry import prepare


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)

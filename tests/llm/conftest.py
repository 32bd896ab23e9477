import pytest

from tests.llm import tables


@pytest.fixture(scope="session")
def tricky(spark):
    """Documents with nulls, empty and long texts, ties, repeats, and columns named like results."""
    return tables.tricky_documents(spark)

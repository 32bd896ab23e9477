import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pairloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return local_session("tests", 8)


@pytest.fixture
def pairs_of(spark):
    """Pairs from (id, instruction, output) tuples, in that order."""

    def make(rows, **extra):
        data = [(i, str(r[0]), r[1], r[2], *[v[i] for v in extra.values()]) for i, r in enumerate(rows)]
        names = ["seq bigint", "id string", "instruction string", "output string", *[f"{k} string" for k in extra]]
        df = spark.createDataFrame(data, ", ".join(names))
        for c in ("input", "category", "difficulty"):
            if c not in df.columns:
                df = df.selectExpr("*", f"CAST(NULL AS STRING) AS {c}")
        return df.selectExpr("*", "map('source', 'user') AS metadata")

    return make


@pytest.fixture
def judgments_of(spark):
    """Judgments from (pair_id, passed, overall[, tag[, reasoning]]) tuples."""

    def make(rows):
        full = [(i, str(r[0]), r[1], float(r[2]), r[3] if len(r) > 3 else "t", r[4] if len(r) > 4 else "ok") for i, r in enumerate(rows)]
        df = spark.createDataFrame(full, "seq bigint, pair_id string, passed boolean, o double, tag string, judgment_reasoning string")
        return df.selectExpr("seq", "pair_id", "struct(o AS coherence, o AS accuracy, o AS helpfulness, o AS overall) AS scores",
                             "passed", "'m' AS judge_model", "judgment_reasoning", "CAST(NULL AS TIMESTAMP) AS judged_at",
                             "struct('default' AS name, 1 AS version) AS rubric", "tag")

    return make


@pytest.fixture
def labels_of(spark):
    """Labels from (pair_id, status[, tag]) tuples."""

    def make(rows):
        full = [(i, str(r[0]), r[1], r[2] if len(r) > 2 else None) for i, r in enumerate(rows)]
        df = spark.createDataFrame(full, "seq bigint, pair_id string, status string, tag string")
        return df.selectExpr("*", "CAST(NULL AS STRING) AS note", "'user' AS labeler", "CAST(NULL AS TIMESTAMP) AS labeled_at")

    return make

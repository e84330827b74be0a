from __future__ import annotations

import pytest
from pyspark.sql import DataFrame

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A table of documents from (doc_id, text) pairs, spread over partitions, with
    columns more whose names the operators use themselves."""

    def build(pairs: list[tuple[int | None, str | None]], partitions: int = 3) -> DataFrame:
        rows = [(i, t, "en", None, len(t or "")) for i, t in pairs]
        df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
        extra = ("row", "name", "key", "n", "word", "text_key", "copies", "component", "node", "ids")
        return df.selectExpr("*", *(f"1 AS {c}" for c in extra))

    return build


@pytest.fixture
def by_id():
    """Rows of a result by their first column, as dicts."""

    def collect(df: DataFrame) -> dict[object, dict[str, object]]:
        rows = [r.asDict() for r in df.collect()]
        assert len({r[df.columns[0]] for r in rows}) == len(rows)
        return {r[df.columns[0]]: r for r in rows}

    return collect

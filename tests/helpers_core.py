"""Shared by the tests of this folder; fixtures are in conftest."""

from __future__ import annotations


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as text."""
    execution = df._jdf.queryExecution()
    return execution.explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode)
    )


def rows(df, *columns):
    """Rows of the named columns, sorted with NULLs first."""
    names = columns or df.columns
    listed = [tuple(r[c] for c in names) for r in df.collect()]
    return sorted(listed, key=lambda r: tuple((v is not None, v) for v in r))

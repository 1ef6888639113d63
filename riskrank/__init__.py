"""Point-in-time risk ranking as Spark DataFrame operators.

Every operator takes DataFrames and column names and returns a DataFrame;
Catalyst sees the whole plan.  Actions happen only where a model is fitted, a
table is written, or lineage is cut on purpose (`riskrank.session.cut_lineage`).
"""

__all__ = ["functions", "operators", "plans", "sources"]

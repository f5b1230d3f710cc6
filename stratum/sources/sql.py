"""SQL-text transforms over named DataFrames (batch or streaming).

A SQL file can stand in for a DataFrame function: the inputs are registered as
temporary views under the names the SQL uses and ``spark.sql`` plans it through
the same Catalyst optimizer.  A temp view over a streaming DataFrame yields a
streaming result, so the same text serves a micro-batch flow.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from stratum.session import read_text

_STREAM = re.compile(r"\bSTREAM\s*\(\s*([`\w.]+)\s*\)", re.IGNORECASE)


def run_sql(spark: SparkSession, sql_text: str, views: dict[str, DataFrame]) -> DataFrame:
    """The SQL's result.  ``STREAM(name)`` reads the named view as a stream: it must be one."""
    for name in _STREAM.findall(sql_text):
        if name not in views or not views[name].isStreaming:
            raise ValueError(f"STREAM({name}): no streaming DataFrame of that name")
    sql_text = _STREAM.sub(r"\1", sql_text)
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return spark.sql(sql_text)


def run_sql_file(spark: SparkSession, path: str, views: dict[str, DataFrame],
                 params: dict[str, str] | None = None) -> DataFrame:
    """Run the SQL in ``path``; ``params`` fills ``{name}`` placeholders (table names)."""
    text = read_text(spark, path)
    if params:
        text = text.format(**params)
    return run_sql(spark, text, views)

"""Plain SQL with parameters, and results as JSON rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Parameter = str | int | float | bool | None


# Text in which a question mark is no parameter: quotes and comments.
_MARKS = re.compile(
    r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`[^`]*`|--[^\n]*|/\*.*?\*/|\?""", re.DOTALL
)


def query_with_parameters(
    spark: SparkSession, text: str, parameters: list[Parameter] | None = None
) -> DataFrame:
    """Run SQL whose ``?`` marks take the parameters in order, typed as given.

    Parameters become literals in the plan, so they prune and reach the scan
    like constants written in the text. They are passed under names, since
    Spark 4.1 mixes up the order of more than four positional ones.
    """
    values = list(parameters or [])
    names = iter(range(len(values)))

    def named(found: re.Match) -> str:
        if found.group() != "?":
            return found.group()
        number = next(names, None)
        if number is None:
            raise ValueError("more parameter marks than parameters")
        return f":p{number}"

    named_text = _MARKS.sub(named, text)
    if next(names, None) is not None:
        raise ValueError("more parameters than parameter marks")
    arguments = {f"p{number}": value for number, value in enumerate(values)}
    return spark.sql(named_text, args=arguments) if arguments else spark.sql(named_text)


def json_rows(frame: DataFrame) -> DataFrame:
    """One JSON object per row, nulls included, made on the executors."""
    everything = F.struct(*[F.col(column) for column in frame.columns])
    return frame.select(F.to_json(everything, {"ignoreNullFields": "false"}).alias("json"))

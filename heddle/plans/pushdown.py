"""A report of what Spark pushed into the scans of a query, and what stays above them."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass
class Report:
    """filters and columns of each scan, whether aggregates are split, and the operators above the scans."""

    filters: list[str] = field(default_factory=list)
    columns: list[str] = field(default_factory=list)
    partial_aggregate: bool = False
    joins: list[str] = field(default_factory=list)
    exchanges: int = 0
    local: list[str] = field(default_factory=list)

    def __str__(self) -> str:
        return "\n".join(f"{k}: {v}" for k, v in vars(self).items())


def plan_text(df: DataFrame) -> str:
    """The formatted plan as text, without running the query."""
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def report(df: DataFrame) -> Report:
    text = plan_text(df)
    out = Report()
    out.filters = [x for x in re.findall(r"PushedFilters: \[(.*)\]", text) if x]
    out.columns = re.findall(r"ReadSchema: struct<(.*)>", text)
    tree = text.split("\n\n")[0]
    names = re.findall(r"[-+:* |(\d)]*?([A-Z]\w+(?: \w+)?) \(\d+\)", tree)
    out.partial_aggregate = "partial_" in text
    out.joins = [n for n in names if n.endswith("Join") or n == "CartesianProduct"]
    out.exchanges = sum(n.split()[0] in ("Exchange", "BroadcastExchange") for n in names)
    out.local = [n for n in names if re.match("Filter|Sort|Window|Generate|HashAggregate|SortAggregate|ObjectHash|TakeOrdered|.*Python|.*Pandas|.*Arrow", n)]
    return out

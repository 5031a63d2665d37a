"""What Spark is going to do for a query, as rows."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

NODE = re.compile(r"^[\s:|+*-]*(?:\(\d+\)\s*)?(?P<name>[A-Z][A-Za-z]+)\b(?P<detail>.*)$")
KINDS = {
    "scan": r"Scan|FileScan", "filter": r"Filter", "exchange": r"Exchange|ShuffleExchange|BroadcastExchange",
    "join": r".*Join", "sort": r"Sort|TakeOrderedAndProject", "aggregate": r".*Aggregate", "window": r"Window|WindowGroupLimit",
    "python": r".*(?:InPandas|InArrow|EvalPython|PythonRDD).*",
}


def plan_rows(query: DataFrame) -> DataFrame:
    """``position, kind, operator, detail, pushed_filters, read_schema`` of the physical plan's operators.

    The plan of adaptive execution before it has run; other operators (projections and the like) are left out.
    """
    rows = []
    for line in query._jdf.queryExecution().executedPlan().toString().splitlines():
        found = NODE.match(line)
        if found is None:
            continue
        name, detail = found["name"], found["detail"]
        kind = next((k for k, names in KINDS.items() if re.fullmatch(names, name)), None)
        if kind is not None:
            pushed = re.search(r"PushedFilters: (\[.*?\]),? ", detail + " ")
            schema = re.search(r"ReadSchema: (struct<.*>)", detail)
            rows.append((len(rows), kind, name, detail.strip(), pushed and pushed[1], schema and schema[1]))
    return query.sparkSession.createDataFrame(
        rows, "position int, kind string, operator string, detail string, pushed_filters string, read_schema string")

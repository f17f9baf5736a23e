"""Writing reports: CSV, JSON lines, Markdown, workbook sheets, dashboard payloads."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A report rendered on the driver has at most so many rows.
RENDER_ROWS = 100_000


def write_csv(df: DataFrame, path: str, order: list[str] | None = None, one_file: bool = False) -> None:
    """A CSV report; sorted across files, in a single one only if asked."""
    out = df.orderBy(*order) if order else df
    (out.coalesce(1) if one_file else out).write.mode("overwrite").option("header", True).option("emptyValue", "").csv(path)


def write_jsonl(findings: DataFrame, path: str) -> None:
    """Findings as JSON lines by path, phase and id; details that are JSON are written as such."""
    details = F.coalesce(F.try_parse_json("details"), F.to_json(F.struct(F.col("details").alias("text"))).try_cast("variant"))
    rows = findings.withColumn("details", details).orderBy("episode_path", "phase", "id")
    rows.select(F.to_json(F.struct(*findings.columns)).alias("value")).write.mode("overwrite").text(path)


def bounded(df: DataFrame, limit: int = RENDER_ROWS) -> list:
    """The rows of a small report; refuses larger ones."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a rendered report has at most {limit} rows")
    return rows


def markdown(title: str, sections: dict[str, DataFrame]) -> str:
    """A Markdown document with a table for each section."""
    lines = [f"# {title}"]
    for name, df in sections.items():
        lines += ["", f"## {name}", "", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join("" if v is None else str(v).replace("|", "\\|") for v in row) + " |" for row in bounded(df)]
    return "\n".join(lines) + "\n"


def write_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """A workbook as one CSV folder a sheet; sheets of too many rows are refused."""
    for df in sheets.values():
        if df.limit(RENDER_ROWS + 1).count() > RENDER_ROWS:
            raise ValueError(f"a sheet has at most {RENDER_ROWS} rows")
    for name, df in sheets.items():
        write_csv(df, f"{path}/{name}", one_file=True)


def dashboard(parts: dict[str, DataFrame]) -> str:
    """A JSON payload of small tables."""
    return json.dumps({k: [r.asDict(True) for r in bounded(v, 5_000)] for k, v in parts.items()}, default=str, sort_keys=True)


def plan_text(plan: DataFrame, digits: int = 6) -> DataFrame:
    """A plan with its numbers written out to ``digits`` decimals."""
    shown = [F.format_string(f"%.{digits}f", c).alias(c) if t == "double" else F.col(c) for c, t in plan.dtypes]
    return plan.select(*shown)

"""HTML table reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quayside.functions.text import escape_html, hyperlink

# Opening and closing of the table.
TABLE_START = '<table border="1" class="dataframe">'
TABLE_END = "</tbody></table>"
TIME_CELL = "yyyy-MM-dd HH:mm:ss"


def _header(names: Sequence[str]) -> str:
    cells = "".join(f"<th>{name}</th>" for name in names)
    return f"{TABLE_START}<thead><tr>{cells}</tr></thead><tbody>"


def _cell(df: DataFrame, name: str, links: Sequence[str]) -> Column:
    value = F.col(f"`{name}`")
    if name in links:
        text = hyperlink(value)
    elif dict(df.dtypes)[name].startswith("timestamp"):
        text = F.date_format(value, TIME_CELL)
    else:
        text = escape_html(value.cast("string"))
    return F.concat(F.lit("<td>"), F.coalesce(text, F.lit("None")), F.lit("</td>"))


def report_lines(
    report: DataFrame, order: Sequence[str], titles: Sequence[str], links: Sequence[str] = ("airflow",)
) -> DataFrame:
    """The report as lines of HTML: ``section`` 0 opens it, 1 is a record, 2 closes it.

    Every record is a row of its own, so a report of any length stays spread over
    the cluster. Cells are escaped; link columns hold an anchor. Without records
    the heading shows the ``titles``, otherwise the column names.
    """
    records = report.select(
        F.lit(1).alias("section"),
        *order,
        F.concat(
            F.lit("<tr>"), *[_cell(report, name, links) for name in report.columns], F.lit("</tr>")
        ).alias("html"),
    )
    blanks = [F.lit(None).cast("string").alias(name) for name in order]
    heading = F.when(F.col("any").isNotNull(), _header(report.columns)).otherwise(_header(titles))
    # The greatest line reads the columns the records read, so both share one shuffle.
    frame = records.agg(F.max("html").alias("any")).select(
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("section"), heading.alias("html")),
                F.struct(F.lit(2).alias("section"), F.lit(TABLE_END).alias("html")),
            )
        ).alias("line")
    )
    frame = frame.select("line.section", *blanks, "line.html")
    return records.unionByName(frame)


def write_report(lines: DataFrame, path: str, order: Sequence[str]) -> str:
    """Write the lines in order; the parts read one after another are the document."""
    lines.orderBy("section", *order).select("html").write.mode("overwrite").text(path)
    return path

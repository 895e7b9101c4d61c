"""Report tabs as CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .. import fixed


def tab(table: DataFrame, name: str) -> DataFrame:
    """Columns of one tab under their headers. Booleans are 0/1, times have no zone."""
    _, columns = fixed.EXPORT_TABS[name]
    types = dict(table.dtypes)

    def cell(c):
        if types[c] == "boolean":
            return F.col(c).cast("int")
        if types[c] == "timestamp":
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        return F.col(c)

    return table.select(*[cell(c).alias(header) for c, header in columns])


def write_tab(rows: DataFrame, path: str, files: int | None = None) -> None:
    """Write one tab, replacing an older one, as CSV with a header in each file.

    Files are written in parallel, one per partition; ``files`` asks for that many instead, whatever the row count is.
    """
    rows = rows if files is None else rows.coalesce(1) if files == 1 else rows.repartition(files)
    (rows.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"')
     .option("emptyValue", "").option("nullValue", "").csv(path))


def export_tabs(tables: dict[str, DataFrame], out: str, files: int | None = None) -> None:
    """Write the six tabs, each to a folder of its name; ``files`` as in write_tab."""
    for name, (table, _) in fixed.EXPORT_TABS.items():
        write_tab(tab(tables[table], name), f"{out.rstrip('/')}/{name}", files)

"""CSV exports."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame


def export_csv(df: DataFrame, path: str) -> str:
    """Write rows as CSV with a header. Line breaks and quotes inside values survive."""
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").csv(path)
    )
    return path


def export_articles(articles: DataFrame, root: str, stamp: str) -> str:
    """Cleaned articles under a time-stamped name."""
    return export_csv(articles, f"{root.rstrip('/')}/articles_{stamp}")


def export_report(sections: dict[str, DataFrame], root: str, stamp: str) -> dict[str, str]:
    """One CSV folder per report section under a time-stamped root."""
    base = f"{root.rstrip('/')}/report_{stamp}"
    return {
        title: export_csv(df, f"{base}/{re.sub(r'[^a-z0-9]+', '_', title.lower())}")
        for title, df in sections.items()
    }

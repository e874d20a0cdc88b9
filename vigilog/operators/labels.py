"""Filters and small projections over parsed entries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions.numeric import float_text_sql, round_exact_sql
from vigilog.schema import FEATURES


def label_filter(df: DataFrame, which: str = "all") -> DataFrame:
    """``anomaly`` or ``normal`` entries; any other word keeps all."""
    if which == "anomaly":
        return df.where(F.col("is_anomaly") == 1)
    if which == "normal":
        return df.where(F.col("is_anomaly") == 0)
    return df


def process_search(df: DataFrame, text: str) -> DataFrame:
    """Case-insensitive substring of the process name; a missing name is ''."""
    name = F.lower(F.coalesce(F.col("top_proc_name"), F.lit("")))
    return df.where(F.contains(name, F.lit(text.lower())))


def fill_features(df: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """Missing model inputs, null or NaN, become 0."""
    return df.withColumns(
        {c: F.coalesce(F.nanvl(F.col(c), F.lit(0.0)), F.lit(0.0)) for c in features}
    )


def fill_records(df: DataFrame) -> DataFrame:
    """All columns as text for display; missing values become ''."""
    def shown(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        return F.coalesce(c.cast("string"), F.lit("")).alias(name)

    return df.select(*[shown(name, kind) for name, kind in df.dtypes])


def flatten(df: DataFrame) -> DataFrame:
    """Entries without the nested list of cores."""
    return df.drop("cpu_cores")


def clock(timestamp: Column) -> Column:
    """Time of day of a timestamp text."""
    return F.substring(timestamp, 12, 8)


def verdict(flag: Column) -> Column:
    return F.when(flag == 1, "ANOMALY").otherwise("NORMAL")


def hit_tag(label: Column) -> Column:
    """Tag of a fired alert: true or false positive."""
    return F.when(label == 1, "TP").otherwise("FP")


def one_decimal(name: str) -> Column:
    """Display text with one decimal (ties away from zero), a dash where missing."""
    shown = round_exact_sql(name, 1, ties="away")
    return F.expr(f"coalesce(get(transform(array({shown}), x -> {float_text_sql('x')}), 0), '—')")

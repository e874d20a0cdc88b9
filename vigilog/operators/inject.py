"""Labelled test anomalies: spikes written into a metrics table."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigilog.functions.draws import uniform
from vigilog.functions.numeric import round_exact
from vigilog.schema import INJECTION_RATE, SEED


def inject_where(
    df: DataFrame, cpu_pick: Column, mem_pick: Column, cpu_value: Column, mem_value: Column
) -> DataFrame:
    """Set core 0 or the memory share of the picked rows, and the status of all.

    Other columns and the input table stay as they are.
    """
    rest = F.slice("cpu_cores", 2, F.greatest(F.size("cpu_cores") - 1, F.lit(0)))
    return df.withColumns(
        {
            "cpu_cores": F.when(cpu_pick, F.concat(F.array(cpu_value), rest)).otherwise(
                F.col("cpu_cores")
            ),
            "mem_used_pct": F.when(~cpu_pick & mem_pick, mem_value).otherwise(
                F.col("mem_used_pct")
            ),
            "status": F.when(cpu_pick, "ANOMALY:CPU_SPIKE")
            .when(mem_pick, "ANOMALY:MEM_SPIKE")
            .otherwise("NORMAL"),
        }
    )


def inject_anomalies(
    df: DataFrame, keys: list[str], rate: float = INJECTION_RATE, seed: int = SEED
) -> DataFrame:
    """Spike a share of the rows, half on CPU (95-100), half on memory (92-99).

    The draw depends on the key columns and the seed only.
    """
    cols = [F.col(c) for c in keys]
    drawn = df.withColumns(
        {
            "_hit": uniform(cols, seed) < rate,
            "_cpu": uniform(cols, seed + 1) < 0.5,
            "_cv": 95 + 5 * uniform(cols, seed + 2),
            "_mv": 92 + 7 * uniform(cols, seed + 3),
        }
    )
    return inject_where(
        drawn,
        F.col("_hit") & F.col("_cpu"),
        F.col("_hit") & ~F.col("_cpu"),
        round_exact("_cv", 1),
        round_exact("_mv", 1),
    ).drop("_hit", "_cpu", "_cv", "_mv")

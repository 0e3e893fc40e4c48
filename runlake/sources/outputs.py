"""Output texts of succeeded runs."""

from pyspark.sql import DataFrame, functions as F

from runlake.schema import SUCCEEDED


def succeeded_outputs(runs: DataFrame) -> DataFrame:
    """(run_id, output) of succeeded runs that recorded one."""
    return (runs.filter((F.col("status") == SUCCEEDED) & F.col("output").isNotNull())
            .select(F.col("id").alias("run_id"), "output"))


def write_outputs(outputs: DataFrame, path: str, mode: str = "error") -> None:
    """Parquet of (run_id, output): one file per task, not one small file per run."""
    outputs.write.mode(mode).parquet(path)

"""What the registered queries and the pipeline share."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Closes every document's ids.
END_ID = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # Python workers started from another folder must find this package, too.
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file lies on this machine and the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)

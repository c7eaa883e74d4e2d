"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylva.session import checkpoint_dir

#: White space of the text contracts, as a Java / RE2 / Python character class.
BLANK = r"[\x20\x09-\x0D]"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def stored(df: DataFrame, label: str, rows_together: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor afterwards costs a file read, not the
    work before it. Later readers fetch only the columns they need. With
    ``rows_together`` a row group has so many rows at most: for rows of
    megabytes, as writers and readers hold a row group's rows at once. Such
    row groups have no dictionaries, which each would have to build anew.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    options = {} if rows_together is None else {"parquet.block.row.count.limit": rows_together, "parquet.enable.dictionary": "false"}
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_of(column: str = "text") -> Column:
    """The text column, null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names close to ``names`` that ``df`` does not have (letter case ignored)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"{name}_"
        taken.add(name.lower())
        out.append(name)
    return out


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; every machine has the package that holds it."""
    import public_tokenizers

    return public_tokenizers.path(name)

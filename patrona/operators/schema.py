"""Schema shaping: names, projections, column lists by type, keys, previews, missing flags."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patrona.scale import hash_sample


def _unique(names: Sequence[str]) -> list[str]:
    seen: dict[str, str] = {}
    for name in names:
        if name.lower() in seen:
            raise ValueError(f"two columns would both be called {name!r}")
        seen[name.lower()] = name
    return list(names)


def clean_column_names(df: DataFrame) -> DataFrame:
    """Strip, lower case, space and hyphen to underscore, characters that tables refuse removed."""
    names = [re.sub(r"[,;{}()\n\t=]", "", re.sub(r"[ -]", "_", c.strip().lower())) for c in df.columns]
    return df.toDF(*_unique(names))


def underscore_spaces(df: DataFrame) -> DataFrame:
    """Spaces to underscores, case kept."""
    return df.toDF(*_unique([c.replace(" ", "_") for c in df.columns]))


def normalize_names(df: DataFrame) -> DataFrame:
    """Strip, space and hyphen to underscore, case kept."""
    return df.toDF(*_unique([re.sub(r"[ -]", "_", c.strip()) for c in df.columns]))


def rename_by_position(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """New names by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(names)} names for {len(df.columns)} columns")
    return df.toDF(*names)


def select_existing(df: DataFrame, columns: Sequence[str], match_case: bool = True, at_least: int = 1) -> DataFrame:
    """The listed columns that exist, each once, in list order.

    With ``match_case=False`` a name that is present only in lower case is taken too.
    """
    present = [c for c in columns if c in df.columns]
    if not match_case:
        present += [c.lower() for c in columns if c not in df.columns and c.lower() in df.columns]
    present = list(dict.fromkeys(present))
    if len(present) < at_least:
        raise ValueError(f"only {len(present)} of the listed columns exist, {at_least} needed")
    return df.select(*[F.col(f"`{c}`") for c in present])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """P10: drop columns by name, whatever their case; absent names are ignored."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def label_and_features(df: DataFrame, target: str, drop: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """The frame with the target as double ``label``, and the names of the remaining features."""
    rest = [c for c in drop_columns(df, target, *drop).columns]
    return df.withColumn("label", F.col(target).cast("double")), rest


def schema_table(df: DataFrame) -> DataFrame:
    """Position, name and type of each column, as a frame."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, name string, type string")


def shape(df: DataFrame) -> DataFrame:
    """One row (n_rows, n_columns)."""
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of numeric columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def text_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of string columns."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in exclude]


def drop_duplicate_names(df: DataFrame) -> DataFrame:
    """Keep the first of several columns that share a name."""
    marked = df.toDF(*[f"{i}|{c}" for i, c in enumerate(df.columns)])
    first: dict[str, int] = {}
    for i, c in enumerate(df.columns):
        first.setdefault(c.lower(), i)
    return marked.select(*[F.col(f"`{i}|{df.columns[i]}`").alias(df.columns[i]) for i in first.values()])


def candidate_keys(df: DataFrame) -> DataFrame:
    """Columns named like an id or a customer, with distinct counts against the row count."""
    names = [c for c in df.columns if "id" in c.lower() or "customer" in c.lower()]
    row = df.agg(F.count("*").alias("n_rows"),
                 *[F.count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(names)])
    lines = [F.struct(F.lit(c).alias("column"), F.col(f"d{i}").alias("n_distinct"), F.col("n_rows"),
                      (F.col(f"d{i}") == F.col("n_rows")).alias("is_key")) for i, c in enumerate(names)]
    return row.select(F.inline(F.array(*lines)))


def preview(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First n rows in a fixed order."""
    return df.orderBy(*order).limit(n)


def missing_flag(df: DataFrame, *columns: str) -> DataFrame:
    """``<column>_missing`` flags."""
    return df.withColumns({f"{c}_missing": F.col(c).isNull() for c in columns})


def missing_matrix(df: DataFrame, key: str, n: int = 500, seed: int = 42) -> DataFrame:
    """Null flags of an exact-size sample of rows."""
    sample = hash_sample(df, key, n, seed)
    return sample.select(key, *[F.col(c).isNull().alias(c) for c in df.columns if c != key])


def missing_patterns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of rows per pattern of nulls (1 = null, in column order), over all rows."""
    flags = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in columns])
    return df.groupBy(flags.alias("pattern")).agg(F.count("*").alias("n"))

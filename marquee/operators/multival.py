"""Multi-value text -> mapping rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions.text import literal_or_csv_tokens, split_csv_list


def build_mapping(df: DataFrame, source: str, value_name: str, id_col: str = "id",
                  out_id: str = "movie_id") -> DataFrame:
    """G1: comma list -> distinct (id, trimmed non-empty token) rows."""
    return (
        df.select(F.col(id_col).alias(out_id), F.explode(split_csv_list(source)).alias(value_name))
        .where(F.col(out_id).isNotNull())
        .distinct()
    )


def build_mapping_from_literal(df: DataFrame, source: str, value_name: str, id_col: str = "id",
                               out_id: str = "movie_id") -> DataFrame:
    """G1 (intent) for list-literal columns: explode the parsed names
    directly, so a name containing a comma stays one token.  ``source`` may
    hold the tokens as an array already."""
    tokens = F.col(source) if dict(df.dtypes)[source].startswith("array") else literal_or_csv_tokens(source)
    return (
        df.select(F.col(id_col).alias(out_id), F.explode(tokens).alias(value_name))
        .where(F.col(out_id).isNotNull())
        .distinct()
    )


def explode_tokens(df: DataFrame, array_col: str, out: str, keep: list[str] | None = None) -> DataFrame:
    """One row per array element, NULL elements dropped."""
    keep = keep or []
    return df.select(*keep, F.explode(array_col).alias(out)).where(F.col(out).isNotNull())


def token_cardinality(df: DataFrame, fields: dict[str, str], id_col: str = "id") -> DataFrame:
    """Distinct tokens per attribute; ``fields`` maps a label to an array
    column.  One scan: tokens of all attributes are stacked then counted."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(label).alias("dimension"), F.col(col).alias("tokens"))
        for label, col in fields.items()
    ])).alias("s")).select("s.dimension", F.explode("s.tokens").alias("token"))
    return stacked.where(F.col("token").isNotNull()).groupBy("dimension").agg(
        F.count_distinct(F.trim("token")).cast("bigint").alias("unique_count"))


def bridge(mapping: DataFrame, dim: DataFrame, on: str, out_cols: list[str],
           id_col: str = "movie_id") -> DataFrame:
    """Distinct join of mapping rows to a dimension on its natural key.
    Dimensions here are small (distinct tokens); AQE broadcasts them when
    their measured size allows and shuffles otherwise.  If the natural key is
    kept, the mapping is made distinct before it takes on the other columns."""
    if on in out_cols:
        return mapping.select(id_col, on).distinct().join(dim.select(*out_cols).distinct(), on).select(id_col, *out_cols)
    return mapping.join(dim, on).select(id_col, *out_cols).distinct()

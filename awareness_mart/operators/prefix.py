"""Join on "the name starts with"."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prefix_join(
    left: DataFrame,
    left_col: str,
    prefixes: DataFrame,
    prefix_col: str,
    how: str = "inner",
    upper: bool = True,
) -> DataFrame:
    """Join rows of ``left`` to every prefix their name starts with.

    Trailing blanks of a prefix do not count. A name may match several prefixes
    and then gives several rows; with ``how="left"`` a name without a match is
    kept once with NULLs.

    A starts-with condition would compare all names with all prefixes. Instead
    each distinct name is cut at the few lengths that prefixes have, and the cut
    text is joined by equality.
    """

    def fold(column):
        return F.upper(column) if upper else column

    wanted = prefixes.withColumn("_prefix", F.rtrim(fold(F.col(prefix_col)))).filter(
        F.col("_prefix").isNotNull()
    )
    wanted = wanted.withColumn("_length", F.length("_prefix"))
    lengths = wanted.select(F.sort_array(F.collect_set("_length"))).scalar()
    names = left.select(left_col).filter(F.col(left_col).isNotNull()).distinct()
    cuts = (
        names.withColumn("_lengths", lengths)
        .select(left_col, F.explode("_lengths").alias("_length"))
        .withColumn("_prefix", F.left(fold(F.col(left_col)), F.col("_length")))
    )
    matches = cuts.join(wanted, ["_length", "_prefix"]).drop("_length", "_prefix")
    return left.join(matches, left_col, how)

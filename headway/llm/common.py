"""What several operators share: table reading, durable intermediate tables, checked broadcasts, text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from headway.session import materialize, scratch_dir

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
#: A side with at most this many narrow rows (a few numbers each) is broadcast, some 100 MB as a hash table.
BROADCAST_ROWS = 2_000_000

__all__ = ["BROADCAST_ROWS", "checkpointed", "fresh", "if_small", "lower_ascii", "materialize", "scratch_dir", "table", "white_words"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """A step of an iteration, cut off from its lineage as a written table. Unlike after checkpoint(), its size is then
    the measured one; estimates carried from step to step multiply with each join."""
    return materialize(df, "step")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that `df` doesn't have, in any spelling."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def if_small(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, hinted for broadcast only where its counted rows stay under the bound; the join shuffles otherwise."""
    return F.broadcast(df) if rows <= most else df


def lower_ascii(text: Column) -> Column:
    """Null is the empty text; A-Z become a-z and nothing else changes."""
    return F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)


def white_words(text: Column) -> Column:
    """The lower-cased words between spaces, tabs and line ends, in order."""
    return F.filter(F.split(lower_ascii(text), r"[ \x09-\x0D]+"), lambda w: w != "")

"""A bitmap of hashed ids, to keep rows that no listed id can match out of a shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroperf.llm.storage import stored


class IdFilter:
    """Which rows may hold a listed id: all that do, and few others; a join decides those.

    The bitmap has 8 bits for each listed id, but ``most_bits`` (8 MB) at most,
    as a table of 64-bit words that is broadcast: a million rows is its bound.
    Beyond that it lets more rows through to the join and stays right. Null ids
    are never listed. It is tested in the JVM, so a stage that goes on in Python
    needs no second worker.
    """

    def __init__(self, ids: DataFrame, most_bits: int = 1 << 26):
        """``ids`` holds one column of ids, which may repeat."""
        name = ids.columns[0]
        n = ids.agg(F.count(name)).first()[0]
        self.bits = min(most_bits, 1 << max(10, (8 * n).bit_length()))
        held = ids.where(F.col(name).isNotNull()).select(F.pmod(F.xxhash64(F.lit("id"), name), F.lit(self.bits)).alias("_filter_at"))
        words = held.groupBy(F.shiftright("_filter_at", 6).alias("_filter_word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(_filter_at & 63 AS int))")).alias("_filter_bits"))
        self.words = stored(words, "id-words")

    def _tested(self, df: DataFrame, id_col: str) -> DataFrame:
        at = F.pmod(F.xxhash64(F.lit("id"), id_col), F.lit(self.bits))
        marked = df.withColumns({"_filter_at": F.when(F.col(id_col).isNotNull(), at)}).withColumn("_filter_word", F.shiftright("_filter_at", 6))
        tested = marked.join(F.broadcast(self.words), "_filter_word", "left")  # at most most_bits / 64 rows
        hit = F.coalesce(F.expr("(shiftrightunsigned(_filter_bits, cast(_filter_at & 63 AS int)) & 1L) = 1"), F.lit(False))
        return tested.withColumn("_filter_hit", hit).drop("_filter_at", "_filter_word", "_filter_bits")

    def hits(self, df: DataFrame, id_col: str) -> DataFrame:
        return self._tested(df, id_col).where("_filter_hit").select(*[f"`{c}`" for c in df.columns])

    def misses(self, df: DataFrame, id_col: str) -> DataFrame:
        """Rows that no listed id can match."""
        return self._tested(df, id_col).where("not _filter_hit").select(*[f"`{c}`" for c in df.columns])


def without_listed(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """Rows whose id is not in ``ids`` (one column, repeats allowed); only possible matches are shuffled. A null id stays."""
    f = IdFilter(ids)
    listed = ids.toDF("_filter_listed").distinct()
    return f.misses(df, id_col).unionByName(f.hits(df, id_col).join(listed, F.col(id_col) == F.col("_filter_listed"), "left_anti"))

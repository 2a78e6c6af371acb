"""Two versions of a dataset stored side by side, bucketed by the key they are compared by: comparisons join without an exchange."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aeroperf.functions.numbers import count_if
from aeroperf.sinks.files import scratch


class StoredSides:
    """Both sides, written once as tables of ``buckets`` files each that the same keys go to.

    A key is compared as the text of its columns, in which a null is a value, so
    that null keys meet as well without being joined null-safely. Rows of one
    key lie in one bucket: choose another key, or compare by aggregation
    (``reconcile.keyed_diff``), where one key holds a large share of the rows.
    """

    def __init__(self, left: DataFrame, right: DataFrame, key: tuple[str, ...], buckets: int = 64):
        self.spark, self.key, self._names = left.sparkSession, key, []
        self.left, self.right = (self._stored(df, side, buckets) for df, side in ((left, "left"), (right, "right")))

    def _stored(self, df: DataFrame, side: str, buckets: int) -> DataFrame:
        name = f"sides_{side}_{uuid.uuid4().hex[:12]}"
        marked = df.withColumn("_key", F.to_json(F.struct(*self.key), {"ignoreNullFields": "false"}))
        marked.repartition(buckets, "_key").write.bucketBy(buckets, "_key").sortBy("_key").option("path", scratch(self.spark, name)).saveAsTable(name)
        self._names.append(name)
        return self.spark.table(name)

    def only(self, side: str = "left") -> DataFrame:
        """Rows of a side whose key the other lacks."""
        own, other = (self.left, self.right) if side == "left" else (self.right, self.left)
        return own.join(other.select("_key"), "_key", "left_anti").drop("_key")

    def shared(self) -> DataFrame:
        """Rows of the left whose key the right has too."""
        return self.left.join(self.right.select("_key"), "_key", "left_semi").drop("_key")

    def paired(self, fields: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
        """key, and each field as <field>_l and <field>_r: the first row in ``order`` of each key on either side. Null keys pair."""

        def first(df: DataFrame, tag: str, keep: tuple[str, ...]) -> DataFrame:
            best = F.min_by(F.struct(*[F.col(c) for c in keep], *[F.col(f).alias(f"{f}_{tag}") for f in fields]), F.struct(*[F.col(c) for c in order]))
            return df.groupBy("_key").agg(best.alias("_b")).select("_key", "_b.*")

        return first(self.left, "l", self.key).join(first(self.right, "r", ()), "_key").drop("_key")

    def diff(self) -> DataFrame:
        """n_left, n_right, n_both, only_left, only_right: distinct keys; one row."""
        has = lambda df, name: df.groupBy("_key").agg(F.lit(True).alias(name))
        both = has(self.left, "l").join(has(self.right, "r"), "_key", "full")
        l, r = F.col("l").isNotNull(), F.col("r").isNotNull()
        return both.agg(count_if(l).alias("n_left"), count_if(r).alias("n_right"), count_if(l & r).alias("n_both"), count_if(l & ~r).alias("only_left"), count_if(r & ~l).alias("only_right"))

    def drop(self) -> None:
        """Forget the tables and delete their files."""
        fs = self.spark.sparkContext._jvm.org.apache.hadoop.fs
        for df, name in zip((self.left, self.right), self._names):
            folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            for folder in folders:
                at = fs.Path(folder)
                at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)

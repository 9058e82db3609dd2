"""J6, U3 over many runs: an index of the keys seen so far, in a bucketed table.

The index holds each key once, dealt to buckets by its hash and sorted in them.
A run sends its distinct keys to the buckets; the index is read where it lies and
never shuffled, however long the history. The rows themselves stay in place while
at most 100,000 of their keys were seen (the keys found are then broadcast);
beyond that they are joined on the key's hash.
"""

from __future__ import annotations

import hashlib
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio.operators.util import measured_broadcast


class SeenKeys:
    """An index at ``path`` (a folder that all executors reach) for keys of the
    columns in ``schema``. ``buckets`` is fixed when the index is made; another
    number later is an error. Null keys are keys like others, as in a seen-set.
    One run at a time may add."""

    def __init__(self, spark: SparkSession, path: str, schema: str = "url STRING", buckets: int = 256):
        self.spark, self.buckets = spark, buckets
        self.keys = T._parse_datatype_string(schema).names
        if buckets < 1 or "h" in self.keys:
            raise ValueError("an index has at least one bucket, and no key column named h")
        self._fixed_buckets(path.rstrip("/"))
        where = f"{path.rstrip('/')}/of-{buckets}"
        self.table = "seen_" + hashlib.md5(where.encode()).hexdigest()
        quoted = where.replace("\\", "\\\\").replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (h BIGINT, {schema}) USING parquet "
                  f"CLUSTERED BY (h) SORTED BY (h) INTO {buckets} BUCKETS LOCATION '{quoted}'")
        spark.catalog.refreshTable(self.table)

    def _fixed_buckets(self, path: str) -> None:
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        there = {s.getPath().getName() for s in fs.listStatus(folder)} if fs.exists(folder) else set()
        other = {n for n in there if n.startswith("of-")} - {f"of-{self.buckets}"}
        if other:
            raise ValueError(f"the index at {path} has {sorted(other)[0][3:]} buckets")

    def _hashed(self, df: DataFrame, cols: Sequence[str]) -> DataFrame:
        """Distinct keys, a hot key cut to one row a task before the shuffle."""
        return df.select(F.xxhash64(*cols).alias("h"), *[F.col(c).alias(k) for c, k in zip(cols, self.keys)]).distinct()

    def _same(self, left: str, right: str) -> Column:
        """Equal hash, and equal keys as a residual: the join is dealt by the hash
        alone, as the buckets are."""
        cond = F.col(f"{left}.h") == F.col(f"{right}.h")
        for k in self.keys:
            a, b = F.col(f"{left}.{k}"), F.col(f"{right}.{k}")
            cond = cond & F.coalesce(a == b, a.isNull() & b.isNull())
        return cond

    def _against_index(self, keys: DataFrame, how: str) -> DataFrame:
        index = self.spark.table(self.table).hint("merge").alias("i")
        return keys.alias("k").join(index, self._same("k", "i"), how)

    def seen(self, df: DataFrame, key_cols: Sequence[str] | None = None) -> DataFrame:
        """The distinct keys of ``df`` that are in the index, with their hash."""
        return self._against_index(self._hashed(df, key_cols or self.keys), "left_semi")

    def unseen(self, df: DataFrame, key_cols: Sequence[str] | None = None) -> DataFrame:
        """Rows of ``df`` whose key isn't in the index (all of a new key's rows)."""
        cols = list(key_cols or self.keys)
        found = measured_broadcast(self.seen(df, cols)).select(F.col("h").alias("_h"), *[F.col(k).alias(f"_s_{k}") for k in self.keys])
        cond = F.xxhash64(*[df[c] for c in cols]) == found["_h"]
        for c, k in zip(cols, self.keys):
            cond = cond & F.coalesce(df[c] == found[f"_s_{k}"], df[c].isNull() & found[f"_s_{k}"].isNull())
        return df.join(found, cond, "left_anti")

    def add(self, df: DataFrame, key_cols: Sequence[str] | None = None) -> None:
        """Add the keys of ``df``; those that are there already aren't added
        again, so a run may be repeated. One file a bucket and run."""
        new = self._against_index(self._hashed(df, key_cols or self.keys), "left_anti")
        (new.repartition(self.buckets, "h").write.mode("append").format("parquet")
         .bucketBy(self.buckets, "h").sortBy("h").saveAsTable(self.table))
        self.spark.catalog.refreshTable(self.table)

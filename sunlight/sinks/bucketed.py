"""Tables stored in buckets of a key, for joins and aggregates that are done again and again.

Both sides of a join written with the same key and number of buckets are joined
bucket by bucket: neither the join nor an aggregate whose grouping holds the key needs an
exchange, whatever the sizes. A bucket is one task, and a plan without an exchange
leaves AQE nothing to split: keep a fact of which one key holds a large share as a
plain table, where the shuffle join splits it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame

BUCKET_BYTES = 16 << 20                  # of input files behind a bucket
LEAST_BUCKETS, MOST_BUCKETS = 8, 20_000


def buckets_for(*frames: DataFrame) -> int:
    """Buckets for tables made of ``frames``, to be given to each of them: they grow with the files read, so that a
    bucket, which is one task, does not. Only file lengths are looked up (no job)."""
    jvm, conf = frames[0].sparkSession._jvm, frames[0].sparkSession._jsc.hadoopConfiguration()
    paths = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(f)) for f in sorted({f for df in frames for f in df.inputFiles()})]
    size = sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in paths)
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, -(-size // BUCKET_BYTES)))


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store ``df`` at ``path`` as table ``name`` of the session's catalogue, one sorted file per bucket; read back."""
    (df.repartition(buckets, *keys).write.mode("overwrite").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return df.sparkSession.table(name)

"""What a Python worker gets at once."""

import pyarrow as pa
from pyspark.sql import functions as F

from metroflux.llm.common import BATCH_BYTES, map_rows


def test_batches_are_bounded_in_bytes(spark):
    """Forty texts of 1 MB are far fewer rows than a slice holds, yet no batch holds them all."""
    docs = spark.range(0, 40, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))

    def sizes(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"rows": [batch.num_rows], "bytes": [batch.nbytes]})

    got = map_rows(docs, sizes, "rows long, bytes long").collect()
    assert sum(r["rows"] for r in got) == 40
    assert max(r["bytes"] for r in got) <= 2 * BATCH_BYTES


def test_a_sessions_own_limit_stays(spark):
    other = spark.newSession()
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    other.conf.set(key, "1m")
    rows = map_rows(other.range(3).select("id"), lambda batch: batch, "id long").count()
    assert (rows, other.conf.get(key)) == (3, "1m")

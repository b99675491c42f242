"""Make a k-times replicated copy of a test-table folder (for scaling runs).

    python tools/replicate.py SRC_DIR DST_DIR K

Keys get per-copy offsets so they stay unique; text columns are copied as
is, so every document text exists k times (a large group of copies, which
the keep-last dedupe must absorb).  Runs on Spark; writes one Parquet
directory per table, named like the source file.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

KEYS = {  # table -> {column: table whose max key sets the offset}
    "customer": {"c_custkey": "customer"},
    "orders": {"o_orderkey": "orders", "o_custkey": "customer"},
    "lineitem": {"l_orderkey": "orders"},
    "documents": {"doc_id": "documents"},
    "labels": {"doc_id": "documents"},
    "pages": {"page_id": "pages"},
    "events": {"event_id": "events"},
}
KEY_OF = {"customer": "c_custkey", "orders": "o_orderkey", "documents": "doc_id",
          "pages": "page_id", "events": "event_id"}
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def main(src: str, dst: str, k: int) -> None:
    from pyspark.sql import functions as F
    from quire.session import get_session
    spark = get_session()
    read = lambda t: spark.read.parquet(f"{src}/{t}.parquet")
    offsets = {t: int(read(t).agg(F.max(c)).first()[0]) + 1 for t, c in KEY_OF.items()}
    for t in TABLES:
        df = read(t)
        if t in KEYS:
            df = df.withColumn("_rep", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
            for col, owner in KEYS[t].items():
                df = df.withColumn(col, (F.col(col) + F.col("_rep") * F.lit(offsets[owner]))
                                   .cast(df.schema[col].dataType))
            df = df.drop("_rep")
        df.write.mode("overwrite").parquet(f"{dst}/{t}.parquet")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]))

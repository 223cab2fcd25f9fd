import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows, extra=False):
    """documents from (doc_id, text, source); ``extra`` adds columns that clash with names used inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, t, "en", s, len(t) if t is not None else None) for i, t, s in rows], DOCS)
    if extra:
        for c in ("id", "size", "fp", "node", "component", "pattern", "h", "rank", "piece", "length", "label", "kept",
                  "score", "line", "tok", "n", "start", "offset"):
            df = df.withColumn(c, F.lit("x"))
    return df

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, rows):
    """rows: (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], *(r[2:] or ("en", "src0")), len(r[1] or "")) for r in rows]
    return spark.createDataFrame(full, DOCS)

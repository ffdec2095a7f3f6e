"""Documents with everything that real ones have: NULLs, repeats, ties, empty and long texts, clashing columns."""

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use for columns of their own.
        *[T.StructField(name, T.StringType()) for name in ("row", "mark", "print", "shard", "score", "key", "size", "tokens")],
    ]
)
LABELS = "doc_id long, quality int, toxic int"
BENCHMARK = "item_id long, text string"


def document(doc_id, text, **other):
    return tuple({"doc_id": doc_id, "text": text, "mark": "m", "row": "r", **other}.get(f.name) for f in DOCUMENTS)


@pytest.fixture
def documents(spark):
    def make(*pairs):
        return spark.createDataFrame([document(i, t) for i, t in pairs], DOCUMENTS)

    return make


WORDS = "amber birch cedar delta ember fjord grove heath islet jetty knoll larch marsh north ocean prairie quartz ridge".split()
PROSE = " ".join(WORDS)
MESSY = [
    (1, PROSE), (2, PROSE), (2, PROSE), (3, None), (None, None), (None, "unlike"), (4, ""), (5, "   \n"),
    (6, "word " * 30_000), (7, PROSE.upper()), (8, "x"), (8, "y"), (9, "ünïcode ☃ \x00 text"), (-5, PROSE), (None, PROSE),
]

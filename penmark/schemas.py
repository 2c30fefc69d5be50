"""The declared schema of every stage; nothing is inferred at run time.

``pos`` is the ingest position of a record inside its source. It is fixed when the
record lands, so "first occurrence" keeps its meaning in a distributed table.
"""

from __future__ import annotations

from pyspark.sql import types as T

_S, _I, _L, _D, _TS = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_POST = _schema(
    ("text_id", _S), ("text", _S), ("user_id", _S), ("label", _I),
    ("username", _S), ("created_at", _TS), ("source", _S), ("pos", _L),
)
RAW_GENERATED = _schema(
    ("text_id", _S), ("text", _S), ("label", _I), ("prompt_name", _S),
    ("model", _S), ("temperature", _D), ("pos", _L),
)
HUMAN_CSV = _schema(
    ("target", _I), ("id", _S), ("date", _S), ("flag", _S), ("user", _S), ("text", _S),
)
MAIN = _schema(("text", _S), ("label", _I), ("text_id", _L))
TOKENS = _schema(("text_id", _L), ("tokens", T.ArrayType(_S)), ("human_wrote", _I))
ENCODED = _schema(("text_id", _L), ("ids", T.ArrayType(_I)), ("label", _I), ("split", _S))
VOCAB = _schema(("word", _S), ("n", _L), ("idx", _L))
MODEL_FILE = _schema(("path", _S), ("size", _L), ("modified", _TS))
HISTORY = _schema(
    ("run", _S), ("epoch", _I), ("loss", _D), ("train_acc", _D), ("val_acc", _D), ("lr", _D),
)

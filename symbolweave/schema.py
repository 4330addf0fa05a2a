"""Table schemas. A graph is five tables; every id is scoped by the source that issued it."""

from pyspark.sql import types as T

_S, _L, _I, _B = T.StringType(), T.LongType(), T.IntegerType(), T.BooleanType()


def _struct(*fields):
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RELATIONSHIP = _struct(
    ("symbol", _S), ("is_reference", _B), ("is_implementation", _B), ("is_type_definition", _B), ("is_definition", _B),
)
DOCUMENTS = _struct(
    ("source", _S), ("doc_id", _L), ("relative_path", _S), ("language", _S), ("position_encoding", _S), ("text", _S),
)
SYMBOLS = _struct(
    ("symbol_source", _S), ("symbol_id", _L), ("symbol", _S), ("display_name", _S), ("kind", _I),
    ("documentation", _S), ("relationships", T.ArrayType(RELATIONSHIP)),
)
CHUNKS = _struct(
    ("source", _S), ("chunk_id", _L), ("doc_id", _L), ("chunk_index", _I), ("start_line", _I), ("end_line", _I),
)
MENTIONS = _struct(("source", _S), ("chunk_id", _L), ("symbol_source", _S), ("symbol_id", _L), ("role", _I))
DEFINITION_RANGES = _struct(
    ("source", _S), ("symbol_source", _S), ("symbol_id", _L), ("doc_id", _L),
    ("start_line", _I), ("start_char", _I), ("end_line", _I), ("end_char", _I),
)
# Read-optimised edges: mentions already joined to their chunk, document and symbol.
SITES = _struct(
    ("source", _S), ("symbol_source", _S), ("symbol_id", _L), ("symbol", _S), ("role", _I),
    ("relative_path", _S), ("start_line", _I), ("end_line", _I), ("symbol_bucket", _I),
)
# The same edges for questions that start from a file.
FILE_SITES = _struct(
    ("source", _S), ("symbol", _S), ("role", _I), ("relative_path", _S), ("start_line", _I), ("end_line", _I),
    ("file_bucket", _I),
)
# Read-optimised definition ranges: joined to their document and symbol.
DEFINITION_SITES = _struct(
    ("source", _S), ("symbol_source", _S), ("symbol_id", _L), ("symbol", _S), ("relative_path", _S),
    ("start_line", _I), ("start_char", _I), ("end_line", _I), ("end_char", _I), ("symbol_bucket", _I),
)
OCCURRENCES = _struct(
    ("source", _S), ("relative_path", _S), ("symbol", _S), ("role", _I),
    ("range", T.ArrayType(_I)), ("enclosing_range", T.ArrayType(_I)),
)
SYMBOL_INFO = _struct(
    ("source", _S), ("relative_path", _S), ("symbol", _S), ("display_name", _S), ("kind", _I),
    ("documentation", _S), ("relationships", T.ArrayType(RELATIONSHIP)),
)
SOURCE_LINES = _struct(("source", _S), ("file", _S), ("line_no", _I), ("line", _S))

QUERIES = _struct(("query_id", _S), ("name", _S))
SCOPES = _struct(("query_id", _S), ("scope", _S))
FILES = _struct(("query_id", _S), ("file", _S))
POSITIONS = _struct(("query_id", _S), ("file", _S), ("line", _I))

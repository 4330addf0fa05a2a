import os
import sys

import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql.pandas.types import to_arrow_schema  # noqa: E402

from symbolweave import CodeGraph, schema  # noqa: E402
from symbolweave.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="4", partitions="4", driver_memory="4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    """Frame of the given rows: tuples in schema order, or dicts."""
    def make(fields, rows):
        if isinstance(fields, str):
            fields = spark.createDataFrame([], fields).schema
        names = fields.fieldNames()
        records = [row if isinstance(row, dict) else dict(zip(names, row)) for row in rows]
        return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(fields)), fields)
    return make


@pytest.fixture(scope="session")
def make_graph(frame):
    """Graph of one source from short tuples."""
    def make(documents=(), symbols=(), chunks=(), mentions=(), ranges=(), source="", merged=True, relations=None):
        relations = relations or {}
        return CodeGraph(
            documents=frame(schema.DOCUMENTS, [(source, i, path, lang, None, None) for i, path, lang in documents]),
            symbols=frame(schema.SYMBOLS, [
                (source, i, symbol, "", None, None, [
                    {"symbol": target, "is_reference": False, "is_implementation": impl, "is_type_definition": False,
                     "is_definition": False} for target, impl in relations[i]
                ] if i in relations else None) for i, symbol in symbols
            ]),
            chunks=frame(schema.CHUNKS, [(source, c, d, 0, a, b) for c, d, a, b in chunks]),
            mentions=frame(schema.MENTIONS, [(source, c, source, s, role) for c, s, role in mentions]),
            definition_ranges=frame(schema.DEFINITION_RANGES, [
                (source, source, s, d, a, ac, b, bc) for s, d, a, ac, b, bc in ranges
            ]),
            merged=merged,
        )
    return make


@pytest.fixture(scope="session")
def ask(frame):
    def make(*names):
        return frame(schema.QUERIES, [(n, n) for n in names])
    return make


def rows(df, *columns):
    """Sorted rows of a frame as plain tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, str(v)) for v in r))

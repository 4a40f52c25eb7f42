"""What several test files share; fixtures are in ``conftest.py``."""

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SF = "/root/testdata/sf0.001"


def frame(spark, data, schema):
    """Rows given as tuples, handed over as Arrow, so that reading them starts no Python worker."""
    struct = T._parse_datatype_string(schema)
    records = [dict(zip(struct.names, row)) for row in data]
    table = pa.Table.from_pylist(records, schema=to_arrow_schema(struct))
    return spark.createDataFrame(table, struct)


def rows(df, *columns):
    """Rows as sorted tuples, NULLs first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])

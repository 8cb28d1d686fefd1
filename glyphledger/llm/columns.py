"""Names for helper columns that no column of a given table has."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.types import StructType


def fresh(docs: DataFrame, *stems: str) -> tuple[str, ...]:
    """Each stem with as many underscores in front as it takes to be new, whatever the case."""
    taken = {c.lower() for c in docs.columns}
    out = []
    for stem in stems:
        name = f"_{stem}"
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)


def spark_schema(schema: pa.Schema) -> StructType:
    """The Spark schema of a result whose batches are built in tasks by the Arrow schema."""
    return from_arrow_schema(schema)

"""Adding the results of an Arrow-batched Python function to a DataFrame.

``struct_of`` sends one text column to Python and leaves every other column in
the JVM, so the caller's columns (whatever their names and types) pass through
untouched and only the text crosses the Arrow boundary.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Texts are worked on in runs of about so many bytes, whatever the batch holds.
RUN_BYTES = 1 << 21

#: Most rows of an Arrow batch: whole texts cross in it, so Spark's default of
#: 10,000 rows would hold tens of MB in the JVM and again in each worker.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Works on one run of UTF-8 texts (null: None), gives the values of each column.
RunFn = Callable[[list[bytes | None]], dict]


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    name, k = f"__{stem}", 0
    while name.lower() in taken:
        k += 1
        name = f"__{stem}_{k}"
    return name


def text_runs(batch: pa.Array, limit: int = RUN_BYTES) -> Iterator[list[bytes | None]]:
    """The texts of ``batch`` in runs of at most ``limit`` bytes (a longer
    text is a run of its own)."""
    run: list[bytes | None] = []
    size = 0
    for text in batch.cast(pa.large_binary() if pa.types.is_large_string(batch.type) else pa.binary()):
        text = text.as_py()
        n = len(text) if text else 0
        if run and size + n > limit:
            yield run
            run, size = [], 0
        run.append(text)
        size += n
    if run:
        yield run


def bounded_batches() -> None:
    """Lowers the session's Arrow batch to ``BATCH_ROWS`` rows if it is larger
    (read when a query runs, so it is left so)."""
    spark = SparkSession.getActiveSession()
    if spark is not None and not 0 < int(spark.conf.get(_BATCH_CONF)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def give_back_memory() -> None:
    """Returns freed memory to the system: workers live on between tasks."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def struct_of(text: Column, schema: T.StructType, make: Callable[[], RunFn], run_bytes: int = RUN_BYTES,
              filtered: bool = False) -> Column:
    """A struct column computed from ``text`` by ``make()``, which is called
    once per task on the executor and works on one run of texts at a time.
    ``filtered``: rows are filtered by it, and it is not to be computed again for
    that."""
    bounded_batches()
    fields = [pa.field(f.name, to_arrow_type(f.dataType)) for f in schema.fields]

    @F.arrow_udf(schema)
    def apply(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        work = make()
        for batch in batches:
            parts = []
            for run in text_runs(batch, run_bytes):
                values = work(run)
                parts.append(pa.StructArray.from_arrays(
                    [pa.array(values[f.name], type=f.type) for f in fields], fields=fields))
            yield pa.concat_arrays(parts) if parts else pa.array([], type=pa.struct(fields))
        give_back_memory()

    return (apply.asNondeterministic() if filtered else apply)(text.cast("string"))

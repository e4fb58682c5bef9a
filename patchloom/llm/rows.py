"""Adding columns worked out from a text, one Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes worked on at once inside a task; a longer text is worked on alone.
SLICE_BYTES = 2 << 20
#: Bytes of rows that travel to a Python worker at once, where the session names no bound of its own.
BATCH_BYTES = 4 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str) -> Column:
    """A column by its literal name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of this session by their bytes, unless its user did: a batch stands outside the heap of the executor and in its
    worker at once, and ten thousand rows of text are tens of megabytes. A row larger than the bound travels alone."""
    if spark.conf.get(_BATCH_SETTING, None) is None:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges (start, length) whose texts hold about ``limit`` bytes."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if held and held + size > limit:
            yield start, i - start
            start, held = i, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes) - start


def with_text_columns(
    df: DataFrame, text: str, keep: Sequence[str], fields: Sequence[T.StructField],
    make: Callable[[], Callable[[pa.Array], list]], at_once: int = SLICE_BYTES,
) -> DataFrame:
    """``df`` as a struct column ``row`` of the kept columns, followed by ``fields``.

    ``make()`` runs once per task and returns a function from an Arrow array of texts
    (nulls included) to one list or array per field. The kept columns ride in a struct,
    so that they never clash with the new ones; a text among them travels there alone. It gets texts
    of about ``at_once`` bytes at a time. No shuffle; rows keep their order.
    """
    bounded_batches(df.sparkSession)
    source = df.select(F.struct(*[col(c).alias(c) for c in keep]).alias("row"), col(text).cast("string").alias("text"))
    schema = T.StructType([source.schema["row"], *fields])
    kept = source.schema["row"].dataType
    place = kept.names.index(text) if text in kept.names and kept[text].dataType == T.StringType() else None
    if place is not None:
        source = source.select("row")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        kinds = None
        for batch in batches:
            if kinds is None:
                from pyspark.sql.pandas.types import to_arrow_type

                kinds = [to_arrow_type(f.dataType) for f in fields]
            texts = batch.column(1) if place is None else batch.column(0).field(place)
            for start, length in slices(texts, at_once):
                part = batch.slice(start, length)
                made = work(texts.slice(start, length))
                arrays = [m if isinstance(m, pa.Array) else pa.array(m, type=k) for m, k in zip(made, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *arrays], names=["row", *[f.name for f in fields]])

    return source.mapInArrow(run, schema)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an array of texts laid end to end, and where each text starts (with a last end); null is empty."""
    texts = pa.compute.fill_null(texts.cast(pa.string()), "")
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, dtype=np.int32)[texts.offset: texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(ends):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[ends[0]: ends[-1]], ends - ends[0]

"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import checkpoint_dir

#: The white space of the word and line contracts: space and \t \n \v \f \r.
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` that driver and executors can all reach."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only after a bounded count proves the side has at most ``max_rows`` rows.

    Beyond the bound the frame is returned without a hint, and the join shuffles.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that for an all-ASCII string and is much cheaper."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, LOWER))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` worked out once, whatever the optimiser inlines or pushes down.

    Inside a lambda, a plain reference to a computed column may be replaced by its expression and then be evaluated
    again for every element.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def hash128(*cols: Column) -> list[Column]:
    """Two independent 64-bit hashes: a 128-bit key whose chance collisions are negligible at any corpus size."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit(0x5BD1E995), *cols)]


class Numbering(dict):
    """Numbers things from 1 in the order in which they are first asked for."""

    def __missing__(self, thing: object) -> int:
        n = self[thing] = len(self) + 1
        return n


ARROW = {"boolean": pa.bool_(), "int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary(),
         "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
#: Rows turned into Python objects at a time; Spark bounds the bytes of a batch.
SLICE_ROWS = 1_000


def map_texts(df: DataFrame, text_col: str, keep: list[str], start: Callable[[], Callable[[list], Iterable[dict]]],
              made: dict[str, str], finish: Callable[[Callable], list[dict]] | None = None) -> DataFrame:
    """One Arrow pass over a text column.

    ``start()`` runs once in each task and gives the function from a list of texts (None for NULL) to one dict per
    text; the columns of ``keep`` pass through untouched, so NULL and large ids stay exact. ``made`` names the new
    columns and their types. ``finish`` may add rows, without kept columns, at the end of a task.
    """
    kept = [f"_k{i}" for i in range(len(keep))]
    own = df.select(*[F.col(c).alias(k) for c, k in zip(keep, kept, strict=True)], F.col(text_col).alias("_text"))
    types = [own.schema[k].dataType.simpleString() for k in kept]

    def columns(rows: list[dict]) -> list[pa.Array]:
        return [pa.array([r[c] for r in rows], type=ARROW[t]) for c, t in made.items()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, kinds = start(), None
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                left = [part.column(k) for k in kept]
                kinds = [x.type for x in left]
                rows = list(work(part.column("_text").to_pylist()))
                yield pa.RecordBatch.from_arrays(left + columns(rows), names=kept + list(made))
        if finish and kinds is not None and (rows := finish(work)):
            empty = [pa.nulls(len(rows), type=k) for k in kinds]
            yield pa.RecordBatch.from_arrays(empty + columns(rows), names=kept + list(made))

    schema = ", ".join(f"`{c}` {t}" for c, t in [*zip(kept, types, strict=True), *made.items()])
    return own.mapInArrow(run, schema).withColumnsRenamed(dict(zip(kept, keep, strict=True)))

"""Row-wise numpy work over the texts of a table, in Arrow slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Characters of text worked on at once; a longer text makes a slice of its own.
SLICE_CHARS = 1_000_000

Compute = Callable[[list], Sequence[pa.Array]]


def slices(texts: pa.Array, most: int = SLICE_CHARS) -> Iterator[tuple[int, list]]:
    """(first row, texts) with about ``most`` characters each."""
    start, total, part = 0, 0, []
    for row, text in enumerate(texts.to_pylist()):
        size = len(text) if text is not None else 0
        if part and total + size > most:
            yield start, part
            start, total, part = row, 0, []
        part.append(text)
        total += size
    if part:
        yield start, part


def map_texts(
    df: DataFrame,
    text: str,
    keep: Sequence[str],
    out: str,
    start: Callable[[], Compute],
) -> DataFrame:
    """``keep`` columns of every row, followed by the columns of the DDL string ``out``.

    ``start`` runs once per task and returns the function that turns a list of texts (null: None)
    into one Arrow array per output column. A kept column with the name of an output column, in
    letters of either case, gives way to it; all other columns of ``df`` are ignored.
    """
    fields = df.sparkSession.createDataFrame([], out).schema.fields
    names = [f.name for f in fields]
    kept = without(keep, names)
    row, content = free("row", names), free("text", names)
    source = df.select(row_of(kept).alias(row), quoted(text).alias(content))
    schema = source.select(row).schema
    for field in fields:
        schema = schema.add(field)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = start()
        for batch in batches:
            for first, part in slices(batch.column(1)):
                rows = batch.column(0).slice(first, len(part))
                yield pa.RecordBatch.from_arrays([rows, *compute(part)], names=[row, *names])

    made = source.mapInArrow(run, schema)
    return made.select(*fields_of(row, kept), *map(quoted, names))


def quoted(name: str) -> Column:
    """A column by its plain name, dots and quotes included."""
    return F.col("`" + name.replace("`", "``") + "`")


def free(name: str, taken: Iterable[str]) -> str:
    """The name, lengthened until it is none of the taken ones in letters of either case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def without(names: Iterable[str], gone: Iterable[str]) -> list[str]:
    """The names that are none of ``gone`` in letters of either case."""
    lower = {g.lower() for g in gone}
    return [n for n in names if n.lower() not in lower]


def row_of(names: Sequence[str]) -> Column:
    """The columns as one struct, in which their names meet no others."""
    return F.struct(*map(quoted, names)) if names else F.struct(F.lit(0).alias("none"))


def fields_of(row: str, names: Sequence[str]) -> list[Column]:
    """The columns that ``row_of`` put into ``row``."""
    return [quoted(row).getField(n).alias(n) for n in names]


class Numbering(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = number = len(self)
        return number


def take_runs(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, codes: np.ndarray):
    """Runs ``flat[starts[c]:starts[c] + lengths[c]]`` for every code, one after another."""
    size = lengths[codes]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts[codes] - (ends - size), size)
    return flat[np.arange(total, dtype=np.int64) + shift]


def run_starts(lengths: np.ndarray) -> np.ndarray:
    return np.cumsum(lengths) - lengths


def list_array(values: np.ndarray, sizes: np.ndarray, kind=pa.int32()) -> pa.Array:
    offsets = np.zeros(len(sizes) + 1, dtype=np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def fold(key: str, folds: int) -> Column:
    """crc32 of a key written as text, modulo ``folds``; null keys give null."""
    return F.crc32(F.col(key).cast("string")) % folds

"""What the operators share: words, row columns, and running a function over whole texts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

# A word is a run of anything but the six ASCII white space characters. The
# possessive quantifier keeps Java from remembering every place to go back to.
WORD = r"[^\x20\x09-\x0D]++"

ROW = "__row"


def whole_text(column: str = "text") -> Column:
    """The text; empty where it is NULL."""
    return F.coalesce(F.col(column), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def random_key(seed: int, identity: Column, text: Column) -> Column:
    """A reproducible random order: a hash of the seed, the id and the text.

    Rows with equal keys are equal in both, so they can change places.
    """
    return F.md5(F.concat_ws(":", F.lit(str(seed)), identity.cast("string"), F.md5(text)))


def packed(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The whole row, or some columns, as one struct, so that they cannot clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in columns or df.columns]).alias(ROW)


def unpacked(columns: Sequence[str], added: Sequence[str]) -> list[Column]:
    """The input's columns, then the added ones, which replace input columns of the same name."""
    taken = {a.lower() for a in added}
    kept = [F.col(ROW).getField(c).alias(c) for c in columns if c.lower() not in taken]
    return [*kept, *[F.col(a) for a in added]]


def per_text(
    df: DataFrame,
    text: str,
    fields: Sequence[tuple[str, str]],
    build: Callable[[], Callable[[str], tuple]],
    keep_text: bool = False,
) -> DataFrame:
    """``df`` with ``fields`` computed from the whole text of each row; NULL counts as empty.

    ``build`` is called once in every task and returns the function applied to
    each text. The rows stay in their partitions and arrive in Arrow batches, so
    a task holds one batch besides what ``build`` keeps.
    """
    added = T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in fields))
    kept = [c for c in df.columns if keep_text or c != text]
    schema = T.StructType([*[df.schema[c] for c in kept], *added.fields])
    types = [to_arrow_type(f.dataType) for f in added.fields]

    def run(batches):
        of = build()
        for batch in batches:
            found = [of(value.as_py() or "") for value in batch.column(text)]
            columns = list(zip(*found, strict=True)) or [()] * len(types)
            arrays = [batch.column(c) for c in kept]
            arrays += [pa.array(values, kind) for values, kind in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return df.mapInArrow(run, schema)

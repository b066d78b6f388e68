"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import spread
from .letters import slices


def named(df: DataFrame, **columns: str) -> DataFrame:
    """Only the columns an operator needs, under its own names, so that other columns can't clash."""
    return df.select(*(F.col(f"`{old}`").alias(new) for new, old in columns.items()))


def map_texts(df: DataFrame, work: Callable, schema: str, text: str = "text") -> DataFrame:
    """``work(columns, texts)`` is called on slices of bounded size and returns a dict of output columns.

    ``columns`` are the other columns of ``df`` as Arrow arrays; map only, no shuffle but for tables of few splits.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text).to_pylist()
            rest = {n: batch.column(n) for n in batch.schema.names if n != text}
            for start, end in slices(texts):
                made = work({n: c.slice(start, end - start) for n, c in rest.items()}, texts[start:end])
                if made is not None:
                    arrays = [v if isinstance(v, pa.Array) else pa.array(v) for v in (made[f.name] for f in out)]
                    yield pa.RecordBatch.from_arrays([a if a.type == f.type else a.cast(f.type) for a, f in zip(arrays, out)], schema=out)

    return spread(df).mapInArrow(run, schema)


def lang_code(lang: Column) -> Column:
    """Two-letter code of any of the spellings ``it``, ``IT``, ``it-IT``, ``ita_Latn``; others and null give ``und``."""
    low = F.lower(F.trim(lang))
    head = F.regexp_extract(low, "^([a-z]+)", 1)
    code = F.when(head.isin("it", "ita"), "it").when(head.isin("tr", "tur"), "tr").when(head.isin("hi", "hin"), "hi")
    code = code.when(head.isin("ar", "ara", "arb"), "ar").when(head.isin("th", "tha"), "th")
    return F.coalesce(code, F.lit("und"))


def fixed_binary(column: pa.Array) -> bytes:
    """The bytes of an Arrow binary column without nulls, end to end."""
    flat = pa.concat_arrays([column]) if column.offset else column
    return b"".join(flat.to_pylist())

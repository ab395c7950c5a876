"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.sources.tables import table

__all__ = ["table", "arrow_map", "canon_label", "canon_language"]


def arrow_map(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """Apply ``fn`` to column lists of each Arrow batch. Partition-local, no shuffle, no pandas."""
    from pyspark.sql.types import StructType
    from pyspark.sql.pandas.types import to_arrow_schema

    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = fn({n: b.column(i).to_pylist() for i, n in enumerate(b.schema.names)})
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in out_schema], schema=out_schema)

    return df.mapInArrow(run, schema)


#: Spellings of the languages of the data, by two-letter code.
LANGUAGE_SPELLINGS = {
    "en": ["eng", "english"],
    "de": ["ger", "deu", "german", "deutsch"],
    "fr": ["fra", "fre", "french", "français", "francais"],
    "es": ["spa", "esp", "spanish", "español", "espanol"],
    "pt": ["por", "portuguese", "português", "portugues"],
    "ru": ["rus", "russian", "русский"],
}


def canon_language(c: Column) -> Column:
    """Language code without region, case or three-letter spelling; NULL where nothing is named."""
    base = F.regexp_extract(F.lower(F.trim(c)), r"^(\p{L}+)", 1)
    out = base
    for code, names in LANGUAGE_SPELLINGS.items():
        out = F.when(base.isin(names), F.lit(code)).otherwise(out)
    return F.when((base == "") | base.isin("none", "null", "unknown", "und", "n"), F.lit(None)).otherwise(out)


def canon_label(c: Column) -> Column:
    """A label without case, blanks, hyphens and underscores, so that ``Text Book`` is ``textbook``; NULL where empty."""
    bare = F.regexp_replace(F.lower(c), r"(?U)[\s_\-]+", "")
    return F.when((bare == "") | bare.isin("none", "null", "n/a", "unknown", "?"), F.lit(None)).otherwise(bare)

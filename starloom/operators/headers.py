"""Header rules. All of them work on column names at plan time and run no job."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom import schemas as S

# An ordered rule list: the first rule whose parts all occur in the header names the target.
ORDER_HEADER_RULES = (
    (("estimated",), "estimated_arrival"),
    (("order", "id"), "order_id"),
    (("user", "id"), "user_id"),
    (("trans",), "transaction_date"),
)
CAMPAIGN_SYNONYMS = {"description": "campaign_description"}


def normal_name(name: str) -> str:
    return re.sub(" ", "_", name.strip().lower())


def _renamed(df: DataFrame, names: Sequence[str]) -> DataFrame:
    clash = sorted({n for n in names if list(names).count(n) > 1})
    if clash:
        raise ValueError(f"headers collide after normalisation: {clash}")
    return df.toDF(*names)


def drop_junk_columns(df: DataFrame) -> DataFrame:
    """Drop index columns without a real header ("Unnamed: 0", blank header)."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not re.search(S.JUNK_HEADER, c.strip())])


def normalise_headers(df: DataFrame, targets: Sequence[str] | None = None) -> DataFrame:
    """Trim, lower case, spaces to underscores. With ``targets``, rename only to those."""
    names = []
    for c in df.columns:
        new = normal_name(c)
        names.append(new if targets is None or new in targets else c)
    return _renamed(df, names)


def rename_synonyms(df: DataFrame, synonyms: Mapping[str, str]) -> DataFrame:
    """Rename on the normalised header through a synonym table."""
    names = [synonyms.get(normal_name(c), normal_name(c)) for c in df.columns]
    return _renamed(df, names)


def fuzzy_headers(
    df: DataFrame, rules: Sequence[tuple[Sequence[str], str]] = ORDER_HEADER_RULES
) -> DataFrame:
    """Rename by the first rule whose words all occur in the header; others stay."""
    names = []
    for c in df.columns:
        low = normal_name(c)
        hit = next((target for words, target in rules if all(w in low for w in words)), c)
        names.append(hit)
    return _renamed(df, names)


def safe_identifier(name: str) -> str:
    """A plain identifier: lower case letters, digits, underscores, not starting with a digit."""
    col = re.sub("[^a-z0-9_]", "_", name.strip().lower()) or "col"
    return f"_{col}" if col[0].isdigit() else col


def sanitise_identifiers(df: DataFrame) -> DataFrame:
    """Safe names for all columns; names that collide get a running number."""
    taken: set[str] = set()
    names = []
    for c in df.columns:
        base = name = safe_identifier(c)
        n = 1
        while name in taken:
            n += 1
            name = f"{base}_{n}"
        taken.add(name)
        names.append(name)
    return df.toDF(*names)


def require_columns(df: DataFrame, required: Sequence[str], what: str = "input") -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks columns {missing}; it has {df.columns}")
    return df


def fill_missing_columns(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add the columns of ``schema`` that are missing, as typed NULLs."""
    lack = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in df.columns}
    return df.withColumns(lack) if lack else df


def constant_flags(df: DataFrame) -> DataFrame:
    """Duplicate flags of hand-made batches: not a duplicate, of nothing."""
    return df.withColumns({
        "possible_duplicate": F.lit(False),
        "possible_duplicate_of": F.lit(None).cast("string"),
    })


def conform(df: DataFrame, schema: T.StructType, keep: Sequence[str] = (S.POSITION,)) -> DataFrame:
    """Declared columns in declared order and type; blank text is NULL. Position is kept."""
    cols = []
    for f in schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            text = c.cast("string")
            c = F.when(text != "", text)
        elif df.schema[f.name].dataType != f.dataType:
            c = c.try_cast(f.dataType)
        cols.append(c.alias(f.name))
    return df.select(*cols, *[k for k in keep if k in df.columns])


def shape(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Declared columns, order and types of already clean data; filters pass through to scans."""
    return df.select(*[
        F.col(f.name) if df.schema[f.name].dataType == f.dataType
        else F.col(f.name).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def union_by_name_text(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of all source columns, every one as text."""
    def as_text(df: DataFrame) -> DataFrame:
        return df.select(*[
            F.col(f"`{c}`") if c == S.POSITION else F.col(f"`{c}`").cast("string").alias(c)
            for c in df.columns])

    return reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [as_text(f) for f in frames])

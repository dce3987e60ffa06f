"""Composite observation fields with quality codes.

Each raw field is a comma-separated string such as ``"160,1,N,0046,1"``.
A ``FieldSpec`` names the source column, the part holding the value, the
part holding its quality code, the missing-value sentinel and the scale.
``decode_observations`` turns all specs into typed columns in one
projection (``split`` + ``get`` + ``try_cast``; no Python UDF), so the
whole decode stays inside whole-stage codegen and filters/projections
above it still reach the Parquet scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Quality codes that mark a reading as unusable.
BAD_QUALITY = ("2", "3", "6", "7")

# Country codes kept by the region filter.
DEFAULT_COUNTRIES = ("US", "GQ", "AQ")


@dataclass(frozen=True)
class FieldSpec:
    name: str                 # output column
    source: str               # raw composite column
    parts: int                # number of comma-separated parts a well-formed value has
    value_part: int           # 0-based index of the value
    quality_part: int | None  # 0-based index of its quality code
    sentinel: float           # "missing" marker, compared after scaling
    scale: float = 1.0        # value is divided by this
    dtype: str = "int"        # "int" or "double"
    empty_is_missing: bool = False  # an empty raw string means "missing" (not malformed)
    bad_value: float | None = None  # value substituted for bad quality (None: the sentinel)


# Layout and sentinels of the decoded weather fields.
#   WindAngle 999, WindSpeed 9999, VerticalVisibility 99999, Visibility 999999,
#   Temperature 999.9, DewPointTemp 999.9, SeaLevelPressure 99999,
#   CloudMode 9, CloudHeight 99999, AtmCondition 9999.
WEATHER_FIELDS: tuple[FieldSpec, ...] = (
    FieldSpec("WindAngle", "WND", 5, 0, 1, 999),
    FieldSpec("WindSpeed", "WND", 5, 3, 4, 9999),
    FieldSpec("VerticalVisibility", "CIG", 4, 0, 1, 99999),
    FieldSpec("Visibility", "VIS", 4, 0, 1, 999999),
    FieldSpec("Temperature", "TMP", 2, 0, 1, 999.9, scale=10.0, dtype="double"),
    FieldSpec("DewPointTemp", "DEW", 2, 0, 1, 999.9, scale=10.0, dtype="double"),
    FieldSpec("SeaLevelPressure", "SLP", 2, 0, 1, 99999),
    FieldSpec("CloudMode", "GD1", 6, 0, 2, 9, empty_is_missing=True),
    FieldSpec("CloudHeight", "GD1", 6, 3, 4, 99999, empty_is_missing=True),
    FieldSpec("AtmCondition", "AW", 2, 0, 1, 9999, empty_is_missing=True),
)

# The source substitutes 99999 (not the 999999 sentinel) for bad-quality
# visibility, so such readings survive as 99999; kept only under strict parity.
PARITY_OVERRIDES = {"Visibility": 99999}


def field_spec(name: str, strict_parity: bool = False) -> FieldSpec:
    for s in WEATHER_FIELDS:
        if s.name == name:
            if strict_parity and name in PARITY_OVERRIDES:
                return FieldSpec(**{**s.__dict__, "bad_value": PARITY_OVERRIDES[name]})
            return s
    raise KeyError(name)


def part(col: Column, i: int, sep: str = ",") -> Column:
    """The ``i``-th (0-based) ``sep``-separated part of a string.

    Two ``substring_index`` calls on a literal separator (no array per row;
    cheaper than ``split`` when only one or two parts are needed).  Only
    meaningful when the string has more than ``i`` parts, which callers
    check with ``n_parts``.
    """
    return F.substring_index(F.substring_index(col, sep, i + 1), sep, -1)


def n_parts(col: Column, sep: str = ",") -> Column:
    """Number of ``sep``-separated parts (an empty string has one)."""
    return F.length(col) - F.length(F.replace(col, F.lit(sep), F.lit(""))) + 1


def _components(spec: FieldSpec) -> dict[str, Column]:
    """Boolean/value pieces of one field, shared by the decoder and the reject report.

    One ``split`` per source (common-subexpression elimination shares the
    array between the parts and fields that use it), then ``get`` by index
    (null when the part is missing) and ``try_cast``.
    """
    raw = F.col(spec.source)
    parts = F.split(raw, ",")
    empty = raw == F.lit("")
    num = F.get(parts, spec.value_part).try_cast("double" if spec.dtype == "double" else "int")
    well_formed = (F.size(parts) == spec.parts) & num.isNotNull()
    if spec.empty_is_missing:
        well_formed = well_formed & ~empty
    bad = F.get(parts, spec.quality_part).isin(*BAD_QUALITY) if spec.quality_part is not None else F.lit(False)
    scaled = num / F.lit(spec.scale) if spec.scale != 1.0 else num
    sentinel = scaled == F.lit(spec.sentinel)
    return {"raw": raw, "empty": empty, "well_formed": well_formed, "bad": bad,
            "value": scaled, "sentinel": sentinel}


def decode_field(spec: FieldSpec) -> Column:
    """One typed column: null when the raw value is null, malformed, empty
    (where that means missing), of bad quality or equal to the sentinel."""
    c = _components(spec)
    out_type = "double" if spec.dtype == "double" else "int"
    value = c["value"].cast(out_type)
    if spec.bad_value is not None:
        bad_out = F.lit(spec.bad_value).cast(out_type)
        bad_out = F.when(F.lit(spec.bad_value) == F.lit(spec.sentinel), F.lit(None).cast(out_type)) \
            .otherwise(bad_out)
        return F.when(c["well_formed"] & c["bad"], bad_out) \
            .when(c["well_formed"] & ~c["sentinel"], value)
    return F.when(c["well_formed"] & ~c["bad"] & ~c["sentinel"], value)


def first_nonempty(cols: Sequence[str], skip_empty: bool = True) -> Column:
    """First usable value of several alternative columns (P14 over AW1..AW7).

    ``skip_empty=True`` treats an empty/blank string as absent so the next
    column is used; ``False`` reproduces a plain ``coalesce`` where an empty
    first column wins.
    """
    if skip_empty:
        return F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in cols])
    return F.coalesce(*[F.col(c) for c in cols])


def decode_observations(df: DataFrame, specs: Sequence[FieldSpec] = WEATHER_FIELDS,
                        drop_sources: bool = True, strict_parity: bool = False) -> DataFrame:
    """Decode every spec into its typed column in one ``withColumns``."""
    if strict_parity:
        specs = [field_spec(s.name, True) if s.name in PARITY_OVERRIDES else s for s in specs]
    out = df.withColumns({s.name: decode_field(s) for s in specs})
    if drop_sources:
        sources = sorted({s.source for s in specs} - {s.name for s in specs})
        out = out.drop(*sources)
    return out


def reject_report(df: DataFrame, specs: Sequence[FieldSpec] = WEATHER_FIELDS) -> DataFrame:
    """Per field: rows, null source, malformed, empty, bad quality, sentinel, valid.

    One aggregate of ``count_if`` over the table, unpivoted to long form
    (one row per field).  Categories are exclusive and sum to ``n_rows``.
    """
    kinds = ["null_source", "malformed", "empty", "bad_quality", "sentinel", "valid"]
    cats = {}
    for s in specs:
        c = _components(s)
        empty = c["empty"] if s.empty_is_missing else F.lit(False)
        cats[f"__cat_{s.name}"] = (F.when(c["raw"].isNull(), 0).when(empty, 2).when(~c["well_formed"], 1)
                                   .when(c["bad"], 3).when(c["sentinel"], 4).otherwise(5))
    coded = df.select(*[v.alias(k) for k, v in cats.items()])
    aggs = [F.count_if(F.col(f"__cat_{s.name}") == i).alias(f"{s.name}__{k}")
            for s in specs for i, k in enumerate(kinds)]
    wide = coded.agg(F.count(F.lit(1)).alias("n_rows"), *aggs)
    stacked = ", ".join(
        f"'{s.name}', " + ", ".join(f"`{s.name}__{k}`" for k in kinds) for s in specs)
    return wide.selectExpr(
        "n_rows",
        f"stack({len(specs)}, {stacked}) as (field, {', '.join('n_' + k for k in kinds)})")


def region_predicate(col: str, countries: Sequence[str] = DEFAULT_COUNTRIES) -> Column:
    """``"NAME, ST CC"`` kept when it has exactly two comma parts, the second is
    two space-separated words and the last word is one of ``countries`` (P15).
    A null name is not kept."""
    c = F.col(col)
    loc = F.trim(part(c, 1))
    return F.coalesce((n_parts(c) == 2) & (n_parts(loc, " ") == 2)
                      & part(loc, 1, " ").isin(*countries), F.lit(False))


def station_name_state(col: str, name: str = "StationName", state: str = "State") -> dict[str, Column]:
    """Station name (text before the comma) and state (first word after it)."""
    c = F.col(col)
    return {name: part(c, 0), state: part(F.trim(part(c, 1)), 0, " ")}

"""Outlier flags, export rules, quality scores and column roles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwright.functions.times import strict_date, text_to_ntz
from panelwright.operators.layout import join_on, settled
from panelwright.operators.quantiles import column_name, quantiles
from panelwright.spec import SeriesSpec

IQR_FACTOR = 1.5
Z_LIMIT = 3.0


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


# --- outliers ------------------------------------------------------------------


def outlier_bounds(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Per key and value: the quartile fences, mean and sample deviation."""
    keys = list(spec.keys)
    quart = quantiles(df, keys, spec.values, (0.25, 0.75), bounded=spec.bounded)
    moments = df.groupBy(*keys).agg(
        *[F.avg(v).alias(f"mean_{v}") for v in spec.values],
        *[F.stddev_samp(v).alias(f"sd_{v}") for v in spec.values],
    )
    both = join_on(moments, quart, keys)
    fences = []
    for v in spec.values:
        q1, q3 = F.col(column_name(v, 0)), F.col(column_name(v, 1))
        fences += [
            (q1 - IQR_FACTOR * (q3 - q1)).alias(f"lower_{v}"),
            (q3 + IQR_FACTOR * (q3 - q1)).alias(f"upper_{v}"),
        ]
    rest = [c for v in spec.values for c in (f"mean_{v}", f"sd_{v}")]
    return both.select(*keys, *fences, *rest)


def outlier_flags(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Adds ``{v}_iqr_outlier`` and ``{v}_z_outlier``; rows are flagged, never removed."""
    bounds = outlier_bounds(df, spec)
    flagged = join_on(df, bounds if spec.bounded else settled(bounds, "bounds"), spec.keys)
    cols: list[Column] = []
    for v in spec.values:
        x = F.col(v)
        outside = (x < F.col(f"lower_{v}")) | (x > F.col(f"upper_{v}"))
        z = F.try_divide(F.abs(x - F.col(f"mean_{v}")), F.col(f"sd_{v}"))
        cols.append(F.coalesce(outside, F.lit(False)).alias(f"{v}_iqr_outlier"))
        cols.append(F.coalesce(z > Z_LIMIT, F.lit(False)).alias(f"{v}_z_outlier"))
    return flagged.select(*df.columns, *cols)


def _any_flag(spec: SeriesSpec) -> Column:
    flags = [F.col(f"{v}_{m}_outlier") for v in spec.values for m in ("iqr", "z")]
    return reduce(lambda a, b: a | b, flags)


def outlier_rows(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Rows that either method flags in any value column."""
    return outlier_flags(df, spec).where(_any_flag(spec)).select(*df.columns)


def outlier_counts(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """Per key: flagged rows by column and method, and their union."""
    flagged = outlier_flags(df, spec)
    counts = [
        F.count_if(F.col(f"{v}_{m}_outlier")).alias(f"{v}_{m}_count") for v in spec.values for m in ("iqr", "z")
    ]
    return flagged.groupBy(*spec.keys).agg(*counts, F.count_if(_any_flag(spec)).alias("outlier_rows"))


# --- scores and rules ------------------------------------------------------------


def _cells(df: DataFrame) -> dict[str, Column]:
    return {f"_nn{i}": F.count(F.col(c)) for i, c in enumerate(df.columns)}


def _score(df: DataFrame) -> Column:
    """From the counts of ``_cells`` plus ``_n``."""
    n, width = F.col("_n"), len(df.columns)
    present = [F.col(f"_nn{i}") for i in range(width)]
    missing = F.lit(width) * n - reduce(lambda a, b: a + b, present)
    empty = reduce(lambda a, b: a + b, [(p == 0).cast("int") for p in present])
    bonus = 5.0 if numeric_columns(df) else 0.0
    share = F.coalesce(F.try_divide(missing * 100.0, F.lit(width) * n), F.lit(0.0))
    return F.greatest(F.lit(0.0), F.least(F.lit(100.0), 100.0 - share - empty * 10 + bonus))


def quality_score(df: DataFrame) -> DataFrame:
    """0 to 100: missing share and empty columns cost points, a numeric column earns five."""
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in _cells(df).items()])
    return counted.select(_score(df).alias("quality_score"))


def completeness(df: DataFrame) -> DataFrame:
    counted = df.agg(F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in _cells(df).items()])
    present = reduce(lambda a, b: a + b, [F.col(n) for n in _cells(df)])
    return counted.select(
        F.try_divide(present * 100.0, F.col("_n") * len(df.columns)).alias("completeness_score")
    )


def duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns, as number and share."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    n, extra = F.sum("_n"), F.sum(F.col("_n") - 1)
    return groups.agg(
        F.coalesce(extra, F.lit(0)).alias("duplicate_rows"),
        F.try_divide(extra * 100.0, n).alias("duplicate_percentage"),
    )


def export_rules(df: DataFrame, required: Sequence[str], time: str | None = None) -> DataFrame:
    """(rule, column, severity, passed): whether a table may be exported, in one pass.

    Of the three missing-value warnings only the strongest that applies fails.
    """
    have = set(df.columns)
    date_ok = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("_n"), *[c.alias(n) for n, c in _cells(df).items()]]
    if time in have:
        parsed = F.col(time)
        if isinstance(df.schema[time].dataType, T.StringType):
            parsed = text_to_ntz(F.col(time))
        aggs.append(F.count(parsed).alias("_dates"))
        at = F.col(f"_nn{df.columns.index(time)}")
        date_ok = (at > 0) & (F.col("_dates") == at)
    counted = df.agg(*aggs)

    def rule(name: str, column: str | None, severity: str, passed: Column) -> Column:
        return F.struct(
            F.lit(name).alias("rule"),
            F.lit(column).cast("string").alias("column"),
            F.lit(severity).alias("severity"),
            passed.alias("passed"),
        )

    rules = [rule("not_empty", None, "error", F.col("_n") > 0)]
    rules += [rule("required_column", c, "error", F.lit(c in have)) for c in required]
    if time in have:
        rules.append(rule("dates_parse", time, "error", date_ok))
    for c in numeric_columns(df):
        missing = F.col("_n") - F.col(f"_nn{df.columns.index(c)}")
        every, most, half = missing == F.col("_n"), missing > F.col("_n") * 0.8, missing > F.col("_n") * 0.5
        rules.append(rule("not_all_missing", c, "warning", ~every))
        rules.append(rule("at_most_80_percent_missing", c, "warning", every | ~most))
        rules.append(rule("at_most_50_percent_missing", c, "warning", most | ~half))
    rules.append(rule("quality_score_50", None, "warning", _score(df) >= 50))
    return counted.select(F.inline(F.array(*rules)))


# --- column roles ----------------------------------------------------------------

# Name parts that hint at a role.
DATE_NAMES = ("fecha", "date", "time", "periodo", "period")
VALUE_NAMES = ("valor", "value", "indice", "index", "ipc")
INDEX_NAMES = ("ipc",)
INDEX_NAMES_ELSE = ("index", "indice", "precio", "price")
TARGET_NAMES = (
    "inflation_rate", "inflacion", "ipc_annual_rate", "ipc_monthly_rate", "annual_rate", "monthly_rate", "rate", "ipc",
)
EPOCH_LIKE = 1e9


def _named(column: str, parts: Sequence[str]) -> bool:
    return any(p in column.lower() for p in parts)


def column_roles(df: DataFrame, date_share: float = 0.9) -> DataFrame:
    """(column, dtype, non_null, date_share, mean, role flags) from the content of the whole table.

    Only text and time columns, or numbers that look like epochs, can be dates;
    a name can break ties but never makes an integer code a date.
    """
    aggs, rows = [F.count(F.lit(1)).alias("_n")], []
    numerics = numeric_columns(df)
    target = next((c for part in TARGET_NAMES for c in df.columns if part in c.lower()), None)
    target = target or (numerics[0] if numerics else None)
    index_names = INDEX_NAMES if any(_named(c, INDEX_NAMES) for c in df.columns) else INDEX_NAMES_ELSE
    for i, field in enumerate(df.schema.fields):
        c, kind = F.col(field.name), field.dataType
        is_number, is_text = isinstance(kind, T.NumericType), isinstance(kind, T.StringType)
        is_time = isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType))
        if is_time:
            dates = F.count(c)
        elif is_text:
            dates = F.count(text_to_ntz(c))
        elif is_number:
            dates = F.count_if(c > EPOCH_LIKE)
        else:
            dates = F.lit(0).cast("long")
        aggs += [F.count(c).alias(f"_c{i}"), dates.alias(f"_d{i}")]
        aggs.append((F.avg(c) if is_number else F.lit(None).cast("double")).alias(f"_m{i}"))
        share = F.coalesce(F.try_divide(F.col(f"_d{i}").cast("double"), F.col(f"_c{i}")), F.lit(0.0))
        date_like = share >= date_share
        rows.append(
            F.struct(
                F.lit(i).alias("position"),
                F.lit(field.name).alias("column"),
                F.lit(kind.simpleString()).alias("dtype"),
                F.col(f"_c{i}").alias("non_null"),
                share.alias("date_share"),
                F.col(f"_m{i}").alias("mean"),
                date_like.alias("date_candidate"),
                F.lit(_named(field.name, DATE_NAMES)).alias("date_named"),
                (F.lit(is_number) & ~date_like).alias("value_candidate"),
                F.lit(_named(field.name, VALUE_NAMES)).alias("value_named"),
                F.lit(is_number and _named(field.name, index_names)).alias("is_price_index"),
                F.lit(field.name == target).alias("is_target"),
            )
        )
    table = df.agg(*aggs).select(F.array(*rows).alias("_rows"))

    def pick(candidate: str, named: str) -> Column:
        fit = F.filter("_rows", lambda r: r[candidate])
        return F.coalesce(
            F.try_element_at(F.filter(fit, lambda r: r[named]), F.lit(1))["column"],
            F.try_element_at(fit, F.lit(1))["column"],
        )

    picked = table.select(
        "_rows",
        pick("date_candidate", "date_named").alias("_date"),
        pick("value_candidate", "value_named").alias("_value"),
    ).select("_date", "_value", F.inline("_rows"))
    return picked.select(
        "column",
        "dtype",
        "non_null",
        "date_share",
        "mean",
        F.col("column").eqNullSafe(F.col("_date")).alias("is_date"),
        F.col("column").eqNullSafe(F.col("_value")).alias("is_value"),
        "is_price_index",
        "is_target",
    )


# --- renames and dates -------------------------------------------------------------

# Source column names and the standard names they stand for.
GENERAL_NAMES = {
    "Fecha": "fecha", "Date": "fecha", "fecha": "fecha",
    "Valor": "ipc_general", "Value": "ipc_general", "valor": "ipc_general",
    "IPC": "ipc_general", "Indice": "ipc_general", "Index": "ipc_general",
}
HARMONISED_NAMES = {
    "Fecha": "fecha", "Date": "fecha", "fecha": "fecha",
    "Valor": "ipca", "Value": "ipca", "valor": "ipca",
    "IPCA": "ipca", "Indice": "ipca", "Index": "ipca",
}
SECTOR_NAMES = {
    "Fecha": "fecha", "Date": "fecha", "fecha": "fecha",
    "Alimentos y bebidas no alcohólicas": "ipc_alimentacion",
    "Bebidas alcohólicas y tabaco": "ipc_bebidas_tabaco",
    "Vestido y calzado": "ipc_vestido",
    "Vivienda": "ipc_vivienda",
    "Menaje": "ipc_menaje",
    "Medicina": "ipc_medicina",
    "Transporte": "ipc_transporte",
    "Comunicaciones": "ipc_comunicaciones",
    "Ocio y cultura": "ipc_ocio",
    "Enseñanza": "ipc_ensenanza",
    "Hoteles, cafés y restaurantes": "ipc_hoteles",
    "Otros": "ipc_otros",
}


def standard_names(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Renames by ``names``; two columns for one standard name are an error."""
    hits = {c: names[c] for c in df.columns if c in names}
    if len(set(hits.values())) < len(hits):
        raise ValueError(f"several columns stand for one name: {hits}")
    return df.withColumnsRenamed(hits)


def sectors_to_panel(df: DataFrame, time: str = "fecha") -> DataFrame:
    """A wide table of sector columns as a panel (sector, time, value)."""
    wide = standard_names(df, SECTOR_NAMES)
    sectors = [c for c in wide.columns if c in set(SECTOR_NAMES.values()) and c != time]
    others = [c for c in wide.columns if c not in sectors]
    return wide.unpivot(others, sectors, "sector", "value")


def date_failures(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, failed): non-NULL texts no date format parses."""
    failed = [
        F.struct(
            F.lit(c).alias("column"),
            F.count_if(F.col(c).isNotNull() & text_to_ntz(F.col(c)).isNull()).alias("failed"),
        )
        for c in columns
    ]
    return df.agg(F.array(*failed).alias("_f")).select(F.inline("_f"))


def date_columns(df: DataFrame, min_share: float = 1.0) -> list[str]:
    """Text columns whose non-NULL values are dates: names of the schema, from one aggregate row."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return []
    share = [F.try_divide(F.count(text_to_ntz(F.col(c))).cast("double"), F.count(c)).alias(c) for c in texts]
    row = df.agg(*share).first()
    return [c for c in texts if row[c] is not None and row[c] >= min_share]


def normalise_dates(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Text columns to time stamps without zone; unparsable texts become NULL."""
    columns = date_columns(df) if columns is None else columns
    return df.withColumns({c: text_to_ntz(F.col(c)) for c in columns}) if columns else df


def round_numbers(df: DataFrame, places: int = 4) -> DataFrame:
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.round(c, places) for c in floats}) if floats else df


def date_range(df: DataFrame, time: str, start: str, end: str) -> DataFrame:
    return df.where(F.col(time).between(strict_date(start), strict_date(end)))

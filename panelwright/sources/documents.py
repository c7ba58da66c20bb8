"""JSON documents of several shapes as rows of records, document by document."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwright.functions.times import any_to_ntz
from panelwright.session import cut_lineage

# The properties a document may keep its records under.
ARRAY_KEY = "Data"
OTHER_ARRAY_KEY = "Datos"
KNOWN_KEYS = ("Data", "data", "Datos", "datos", "Valores", "valores", "Series", "series")
NAME_KEY = "Nombre"
OBJECT_BONUS = 10

STRATEGIES = ("array_of_objects", "direct_list", "known_key", "best_list", "normalise")


def _list(source: str) -> str:
    return f"try_variant_get({source}, '$', 'array<variant>')"


def _object(source: str) -> str:
    return f"try_variant_get({source}, '$', 'map<string,variant>')"


def _unnamed(records: str) -> str:
    return f"transform({records}, r -> named_struct('series', CAST(NULL AS STRING), 'record', r))"


def _candidates(doc: str = "_doc") -> dict[str, str]:
    """Strategy -> SQL expression of its records (NULL or empty where it does not fit)."""
    items = "_items"
    with_data = f"""flatten(transform({items}, i -> transform(
        coalesce(try_variant_get(i, '$.{ARRAY_KEY}', 'array<variant>'), array()),
        r -> named_struct('series', try_variant_get(i, '$.{NAME_KEY}', 'string'), 'record', r))))"""
    first = _object(f"get({items}, 0)")
    is_list = f"NOT array_contains(map_keys({first}), '{ARRAY_KEY}') AND NOT array_contains(map_keys({first}), '{OTHER_ARRAY_KEY}')"
    lists = ", ".join(f"try_variant_get({doc}, '$.{k}', 'array<variant>')" for k in KNOWN_KEYS)
    known = f"get(filter(array({lists}), l -> size(l) > 0), 0)"
    # largest score first, then smallest property name
    scored = f"""array_min(filter(transform(map_entries(_object), e -> named_struct(
        'score', -(size({_list('e.value')}) + IF({_object(f"get({_list('e.value')}, 0)")} IS NOT NULL, {OBJECT_BONUS}, 0)),
        'name', e.key)), s -> s.score < 0)).name"""
    return {
        "array_of_objects": with_data,
        "direct_list": f"IF({is_list}, {_unnamed(items)}, NULL)",
        "known_key": _unnamed(known),
        "best_list": _unnamed(f"try_variant_get(_object[{scored}], '$', 'array<variant>')"),
        "normalise": f"IF({items} IS NOT NULL, {_unnamed(items)}, IF(_object IS NOT NULL, "
        f"array(named_struct('series', CAST(NULL AS STRING), 'record', {doc})), NULL))",
    }


def _choose(df: DataFrame, json: str, strategies: Sequence[str]) -> DataFrame:
    """Adds ``strategy`` and ``_records``: the first strategy that yields records."""
    parsed = (
        df.withColumn("_doc", F.try_parse_json(json))
        .withColumn("_items", F.expr(_list("_doc")))
        .withColumn("_object", F.expr(_object("_doc")))
    )
    # coalesce stops at the first strategy that finds records, the rest is not evaluated
    expressions = _candidates()
    options = [
        f"get(filter(array(named_struct('strategy', '{s}', 'records', {expressions[s]})), c -> size(c.records) > 0), 0)"
        for s in strategies
    ]
    found = parsed.withColumn("_found", F.expr(f"coalesce({', '.join(options)})"))
    return found.select(*df.columns, F.col("_found.strategy").alias("strategy"), F.col("_found.records").alias("_records"))


def parse_documents(
    df: DataFrame, json: str, strategies: Sequence[str] = STRATEGIES
) -> tuple[DataFrame, DataFrame]:
    """(records, quarantine) of documents in the string column ``json``.

    ``records`` has the other columns, the strategy, the name of the series a
    record was listed under and the record as VARIANT; every series of a
    document is read. ``quarantine`` keeps the documents no strategy fits.
    """
    unknown = set(strategies) - set(STRATEGIES)
    if unknown:
        raise ValueError(f"unknown strategies: {sorted(unknown)}")
    chosen = _choose(df, json, strategies)
    others = [c for c in df.columns if c != json]
    records = chosen.where(F.col("strategy").isNotNull()).select(*others, "strategy", F.inline("_records"))
    return records, chosen.where(F.col("strategy").isNull()).select(*df.columns)


def record_fields(records: DataFrame, fields: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Replaces ``record`` by typed columns: name -> (field of the record, type); misfits are NULL."""
    others = [c for c in records.columns if c != "record"]
    cols = [F.try_variant_get("record", f"$.{field}", kind).alias(name) for name, (field, kind) in fields.items()]
    return records.select(*others, *cols)


def read_series(
    records: DataFrame, zone: str = "UTC", time_field: str = "Fecha", value_field: str = "Valor"
) -> DataFrame:
    """Records as ``t`` (local time of ``zone``) and ``value``; dates are epoch numbers or texts."""
    typed = record_fields(records, {"t": (time_field, "string"), "value": (value_field, "double")})
    return typed.withColumn("t", any_to_ntz(F.col("t"), zone))


def flatten_json(df: DataFrame, json: str) -> DataFrame:
    """Objects in a string column as one column per leaf, nested names joined by dots.

    The common schema is found by an aggregate over all documents; only the
    schema text reaches the driver.
    """
    variants = df.withColumn("_v", F.try_parse_json(json))
    found = variants.agg(F.schema_of_variant_agg("_v")).first()[0]
    ddl = found.replace("OBJECT<", "STRUCT<").replace("VOID", "STRING")
    if not ddl.startswith("STRUCT<"):
        raise ValueError(f"not a column of objects: {found}")
    typed = variants.withColumn("_s", F.try_variant_get("_v", "$", ddl)).drop("_v", json)
    leaves: list[Column] = []

    def walk(fields, path: list[str]) -> None:
        for f in fields:
            if hasattr(f.dataType, "fields"):
                walk(f.dataType.fields, [*path, f.name])
            else:
                at = F.col("_s")
                for step in [*path, f.name]:
                    at = at[step]
                leaves.append(at.alias(".".join([*path, f.name])))

    walk(typed.schema["_s"].dataType.fields, [])
    return typed.select(*[c for c in typed.columns if c != "_s"], *leaves)


DEEPEST = 64


def json_leaves(df: DataFrame, json: str, deepest: int = DEEPEST) -> DataFrame:
    """(other columns, path, value): one row per leaf of the documents in a string column, whatever their keys.

    ``flatten_json`` makes a column per leaf, so its schema grows with the keys that occur; here keys are data and the
    driver sees none. Each round opens one level of all objects and lists that are left; names are joined by dots, list
    places stand in brackets. Values are texts; NULLs, empty objects and empty lists are leaves without a value. Texts that
    are no JSON have no leaves. A document nested deeper than ``deepest`` is an error.
    """
    ids = [c for c in df.columns if c != json]
    own = F.struct(*ids).alias("_ids") if ids else F.lit(0).alias("_ids")
    level = df.select(own, F.lit("").alias("path"), F.try_parse_json(json).alias("_v")).where(F.col("_v").isNotNull())
    out = None
    for depth in range(deepest + 1):
        kind = F.schema_of_variant("_v")
        level = cut_lineage(level.withColumn("_kind", F.when(kind.startswith("OBJECT<"), "object").when(kind.startswith("ARRAY<"), "list").otherwise("leaf")), "json-level")
        members = F.map_entries(F.expr("try_variant_get(_v, '$', 'map<string,variant>')"))
        items = F.expr("try_variant_get(_v, '$', 'array<variant>')")
        empty = F.coalesce(F.when(F.col("_kind") == "object", F.size(members)).when(F.col("_kind") == "list", F.size(items)), F.lit(0)) == 0
        leaves = level.where(empty).select("_ids", "path", F.when(F.col("_kind") == "leaf", F.try_variant_get("_v", "$", "string")).alias("value"))
        out = leaves if out is None else out.unionByName(leaves)
        dot = F.when(F.col("path") == "", "").otherwise(F.concat("path", F.lit(".")))
        inner = F.when(F.col("_kind") == "object", F.transform(members, lambda e: F.struct(F.concat(dot, e["key"]).alias("path"), e["value"].alias("v")))).otherwise(
            F.transform(items, lambda x, i: F.struct(F.concat("path", F.lit("["), i.cast("string"), F.lit("]")).alias("path"), x.alias("v")))
        )
        level = level.where(~empty).select("_ids", F.explode(inner).alias("_m")).select("_ids", F.col("_m.path").alias("path"), F.col("_m.v").alias("_v"))
        if level.isEmpty():
            return out.select(*([F.col("_ids.*")] if ids else []), "path", "value")
    raise ValueError(f"documents are nested deeper than {deepest}")

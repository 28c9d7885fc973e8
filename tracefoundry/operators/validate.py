"""Validation of examples: a table of rules that yields a column of error texts."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: what a valid example may hold
REQUIRED = ("id", "version", "split", "source", "instrument", "timeframe", "timestamp_context", "system_prompt", "context", "reasoning", "decision")
SPLITS = ("train", "val", "test")
SOURCES = ("own_journal", "kol_post", "research_note", "chat_log", "on_chain", "synthetic")
DIRECTIONS = ("LONG", "SHORT", "FLAT", "WAIT")
VERDICTS = ("WIN", "LOSS", "SCRATCH", "EXPIRED")
UUID = r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
VERSION = r"^\d+\.\d+$"
DATETIME = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?$"
LEAST_LENGTH = {"system_prompt": 10, "context": 20, "reasoning": 50, "instrument": 1, "timeframe": 1}


def _says(bad: Column, text: str) -> Column:
    return F.when(F.coalesce(bad, F.lit(False)), F.lit(text))


def typed_errors() -> Column:
    """Errors of an example under the fixed schema, where absent and null are one."""
    d, o, q = F.col("decision"), F.col("outcome"), F.col("quality_score")
    missing = F.array_compact(F.array(*[_says(F.col(c).isNull(), f"{c}: missing") for c in REQUIRED]))
    rules = [
        _says(~F.col("id").rlike(UUID), "id: not a UUID"),
        _says(~F.col("version").rlike(VERSION), "version: not N.N"),
        _says(~F.col("split").isin(*SPLITS), "split: unknown"),
        _says(~F.col("source").isin(*SOURCES), "source: unknown"),
        _says(~F.col("timestamp_context").rlike(DATETIME), "timestamp_context: not ISO 8601"),
        *[_says(F.length(c) < n, f"{c}: shorter than {n}") for c, n in LEAST_LENGTH.items()],
        _says(~F.coalesce(d["direction"].isin(*DIRECTIONS), F.lit(False)), "decision.direction: unknown"),
        _says(~F.size(d["entry_zone"]).between(1, 2) & d["entry_zone"].isNotNull(), "decision.entry_zone: not 1 or 2 numbers"),
        _says(d["targets"].isNotNull() & (F.size(d["targets"]) < 1), "decision.targets: empty"),
        _says(~d["confidence"].between(1, 5), "decision.confidence: not in 1..5"),
        _says(~d["position_size_pct"].between(0, 100) | F.isnan(d["position_size_pct"]), "decision.position_size_pct: not in 0..100"),
        _says(~o["verdict"].isin(*VERDICTS), "outcome.verdict: unknown"),
        _says(o["holding_period_hours"] < 0, "outcome.holding_period_hours: negative"),
        _says(~q.between(0.0, 1.0) | F.isnan(q), "quality_score: not in [0, 1]"),
    ]
    return F.when(F.size(missing) > 0, missing).otherwise(F.array_compact(F.array(*rules)))


def json_errors(raw: Column) -> Column:
    """Errors of a foreign JSON object, where an absent key and a null value differ.

    The text is parsed once: the rules read a variable that holds it.
    """
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    return F.element_at(F.transform(F.array(F.try_parse_json(raw)), lambda v: _variant_errors(v, keys)), 1)


def _variant_errors(v: Column, keys: Column) -> Column:

    def kind(path: str) -> Column:
        """Type name of the value at ``path``; null if the key is absent."""
        return F.schema_of_variant(F.try_variant_get(v, path, "variant"))

    def text(path: str) -> Column:
        return F.try_variant_get(v, path, "string")

    def number(path: str) -> Column:
        return F.try_variant_get(v, path, "double")

    def size(path: str) -> Column:
        return F.size(F.try_variant_get(v, path, "array<variant>"))

    numeric = lambda k: k.rlike(r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT|BOOLEAN)$")  # noqa: E731  a bool is an int
    whole = lambda k: k.rlike(r"^(BIGINT|BOOLEAN|DECIMAL\(\d+,0\))$")
    at = lambda path: kind(path).isNotNull()
    bad_text = lambda path, pattern: ~F.coalesce(text(path).rlike(pattern), F.lit(False))
    unknown = lambda path, known: ~F.coalesce((kind(path) == "STRING") & text(path).isin(*known), F.lit(False))
    as_number = lambda path: F.when(kind(path) == "BOOLEAN", F.try_variant_get(v, path, "boolean").cast("double")).otherwise(number(path))
    inside = lambda path, lo, hi: F.coalesce(as_number(path).between(lo, hi), F.lit(False))
    array = lambda path: kind(path).startswith("ARRAY")
    obj = lambda path: kind(path).startswith("OBJECT")
    is_null = lambda path: kind(path) == "VOID"

    missing = F.array_compact(F.array(*[_says(~F.array_contains(keys, c), f"{c}: missing") for c in REQUIRED]))
    d, o = "$.decision", "$.outcome"
    has_d, has_o = obj(d), obj(o)
    rules = [
        _says(bad_text("$.id", UUID), "id: not a UUID"),
        _says(bad_text("$.version", VERSION), "version: not N.N"),
        _says(unknown("$.split", SPLITS), "split: unknown"),
        _says(unknown("$.source", SOURCES), "source: unknown"),
        _says(bad_text("$.timestamp_context", DATETIME), "timestamp_context: not ISO 8601"),
        *[F.when(F.coalesce(kind(f"$.{c}") != "STRING", F.lit(True)), F.lit(f"{c}: not a string")).when(F.length(text(f"$.{c}")) < n, F.lit(f"{c}: shorter than {n}")) for c, n in LEAST_LENGTH.items()],
        _says(~has_d, "decision: not an object"),
        _says(has_d & unknown(f"{d}.direction", DIRECTIONS), "decision.direction: unknown"),
        _says(has_d & at(f"{d}.entry_zone") & ~(array(f"{d}.entry_zone") & size(f"{d}.entry_zone").between(1, 2)), "decision.entry_zone: not 1 or 2 numbers"),
        _says(has_d & at(f"{d}.invalidation") & ~numeric(kind(f"{d}.invalidation")), "decision.invalidation: not a number"),
        _says(has_d & at(f"{d}.targets") & ~(array(f"{d}.targets") & (size(f"{d}.targets") >= 1)), "decision.targets: empty"),
        _says(has_d & at(f"{d}.confidence") & ~(whole(kind(f"{d}.confidence")) & inside(f"{d}.confidence", 1, 5)), "decision.confidence: not in 1..5"),
        _says(has_d & at(f"{d}.position_size_pct") & ~(numeric(kind(f"{d}.position_size_pct")) & inside(f"{d}.position_size_pct", 0, 100)), "decision.position_size_pct: not in 0..100"),
        _says(at(o) & ~is_null(o) & ~has_o, "outcome: not an object"),
        _says(has_o & at(f"{o}.verdict") & unknown(f"{o}.verdict", VERDICTS), "outcome.verdict: unknown"),
        _says(has_o & at(f"{o}.holding_period_hours") & ~(numeric(kind(f"{o}.holding_period_hours")) & (as_number(f"{o}.holding_period_hours") >= 0)), "outcome.holding_period_hours: negative"),
        _says(at("$.quality_score") & ~is_null("$.quality_score") & ~(numeric(kind("$.quality_score")) & inside("$.quality_score", 0.0, 1.0)), "quality_score: not in [0, 1]"),
        _says(at("$.tags") & ~is_null("$.tags") & ~array("$.tags"), "tags: not a list"),
    ]
    whole_object = F.coalesce(kind("$").startswith("OBJECT"), F.lit(False))
    return F.when(~whole_object, F.array(F.lit("not an object"))).when(F.size(missing) > 0, missing).otherwise(F.array_compact(F.array(*rules)))


def with_errors(examples: DataFrame) -> DataFrame:
    return examples.withColumn("errors", typed_errors())


#: Kinds of a VARIANT that a type of JSON Schema takes.
KINDS = {"string": "^STRING$", "number": r"^(BIGINT|DECIMAL.*|DOUBLE|FLOAT)$", "integer": r"^(BIGINT|DECIMAL\(\d+,0\))$", "boolean": "^BOOLEAN$", "array": "^ARRAY", "object": "^OBJECT", "null": "^VOID$"}


def _in_format(text: Column, name: str) -> Column:
    """Whether a text is in a format of JSON Schema; formats that are not known hold for all."""
    if name == "uuid":
        return text.rlike(UUID)
    if name == "date":
        return text.rlike(r"^\d{4}-\d{2}-\d{2}$") & text.try_cast("date").isNotNull()
    if name == "date-time":
        return text.rlike(r"(?i)^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$") & F.upper(text).try_cast("timestamp").isNotNull()
    return F.lit(True)


def _rules(node: dict, x: Column, kind: Column) -> list[tuple[str, Column]]:
    """(what it says, whether it is broken) for each keyword of ``node``, for a VARIANT of a kind; null where there is no value."""
    text, number = F.try_variant_get(x, "$", "string"), F.try_variant_get(x, "$", "double")
    is_text, is_number, is_array, is_object = kind == "STRING", kind.rlike(KINDS["number"]), kind.startswith("ARRAY"), kind.startswith("OBJECT")
    found: list[tuple[str, Column]] = []
    if "type" in node:
        types = node["type"] if isinstance(node["type"], list) else [node["type"]]
        found.append((": type", ~kind.rlike("|".join(KINDS[t] for t in types))))
    if "enum" in node:
        found.append((": enum", kind.isNotNull() & ~F.coalesce(text.isin(*map(str, node["enum"])), F.lit(False))))
    if "pattern" in node:
        found.append((": pattern", is_text & (F.regexp_count(text, F.lit(node["pattern"])) == 0)))
    if "minLength" in node:
        found.append((": minLength", is_text & (F.length(text) < node["minLength"])))
    if "format" in node:
        found.append((": format", is_text & ~_in_format(text, node["format"])))
    found += [(f": {key}", is_number & bad(number, node[key])) for key, bad in (("minimum", Column.__lt__), ("maximum", Column.__gt__)) if key in node]
    if {"minItems", "maxItems", "items"} & set(node):
        elements = F.try_variant_get(x, "$", "array<variant>")
        found += [(f": {key}", is_array & bad(F.size(elements), node[key])) for key, bad in (("minItems", Column.__lt__), ("maxItems", Column.__gt__)) if key in node]
        # of an element, the rules that its place has; the same error of several elements is one
        for n, (says, _) in enumerate(_rules(node.get("items", {}), x, kind)):
            found.append((f"[]{says}", is_array & F.exists(elements, _element_breaks(node["items"], n))))
    if "properties" in node or "required" in node:
        keys = F.json_object_keys(F.to_json(x))
        found += [(f".{k}: required", is_object & ~F.array_contains(keys, k)) for k in node.get("required", [])]
        if node.get("additionalProperties") is False:
            known = F.array(*[F.lit(k) for k in node.get("properties", {})]).cast("array<string>")
            found.append((": additional property", is_object & (F.size(F.array_except(keys, known)) > 0)))
        for k, child in node.get("properties", {}).items():
            inner = F.try_variant_get(x, f"$.{k}", "variant")
            found += [(f".{k}{says}", is_object & bad) for says, bad in _rules(child, inner, F.schema_of_variant(inner))]
    return found


def _element_breaks(node: dict, n: int):
    """Whether an element breaks the n-th rule of ``node``."""
    return lambda e: F.coalesce(_rules(node, e, F.coalesce(F.schema_of_variant(e), F.lit("VOID")))[n][1], F.lit(False))


def schema_errors(raw: Column, schema: dict) -> Column:
    """Errors of JSON texts against a JSON Schema of an object: a rule per keyword of each property.

    Covers required, additionalProperties, type, enum, pattern, minLength,
    format (uuid, date, date-time), minimum, maximum, minItems, maxItems and
    items, nested objects and arrays included.  A text is parsed once.  An
    error names its property, ``[]`` any element of an array.
    """
    v = F.try_parse_json(raw)
    rules = _rules(schema, v, F.schema_of_variant(v))
    found = [_says(bad, f"object{says}" if says.startswith(":") else says.removeprefix(".")) for says, bad in rules]
    return F.when(v.isNull(), F.array(F.lit("not JSON"))).otherwise(F.array_compact(F.array(*found)) if found else F.array().cast("array<string>"))


def load_schema(text: str) -> dict:
    return json.loads(text)

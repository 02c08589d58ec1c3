"""Contract validation generated from rule lists: one projection, no UDF."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidewheel.functions import json_values as jv
from tidewheel.functions.pinning import pinned
from tidewheel.schemas import AUDIT_RULES, Rule, contract_schema

_READERS = {
    "long": jv.whole_number,
    "literal": lambda kind, raw: F.when(kind != "STRING", jv.whole_number(kind, raw)),
    "double": jv.number,
    "text": jv.plain_text,
    "instant": jv.instant,
}


# Sized so that the compiled steps stay below the limit named in `pinned`.
_FIELDS_PER_STEP = 4
_CHECKS_PER_STEP = 8
_SEPARATOR = "; "


def _path(rule: Rule) -> str:
    return f"{rule.section}.{rule.key}" if rule.section else rule.key


def _value(rule: Rule, kind: Column, raw: Column) -> Column:
    """The field in its target type, NULL where the stored value is refused."""
    value = _READERS[rule.kind](kind, raw)
    if rule.default is not None:
        value = F.when(raw.isNull(), F.lit(rule.default)).otherwise(value)
    return value


def _problem(rule: Rule, raw: Column) -> Column:
    """Reason code of the first rule the field breaks, else NULL."""
    value = F.col(rule.name)
    absent = raw.isNull() | F.is_variant_null(raw)
    tests = [(value.isNull() & absent, "missing"), (value.isNull(), "wrong_type")]
    if rule.allowed:
        tests.append((~value.isin(*rule.allowed), "not_allowed"))
    if rule.low is not None:
        below = value <= rule.low if rule.strict_low else value < rule.low
        tests.append((below, "too_small"))
    if rule.high is not None:
        tests.append((value > rule.high, "too_large"))  # NaN sorts above every number
    if rule.min_length:
        tests.append((F.length(value) < rule.min_length, "too_short"))
    return F.coalesce(*[F.when(test, F.lit(f"{rule.name}:{name}")) for test, name in tests])


def validate_record(
    df: DataFrame,
    rules: Sequence[Rule],
    *,
    record: str = "record",
    elsewhere: Mapping[str, tuple[Column, str]] | None = None,
) -> DataFrame:
    """Add one typed column per rule and ``problems``, an array of reason codes.

    A row is valid iff ``problems`` is empty. ``elsewhere`` maps a field to a condition and the
    path it is read from where that condition holds.
    """
    elsewhere = elsewhere or {}
    own = [c for c in df.columns if c not in {r.name for r in rules}]
    paths = [_path(r) for r in rules] + [path for _, path in elsewhere.values()]
    walked = pinned(df, own, {"_at": jv.fields(F.col(record), paths)})

    def located(rule: Rule) -> Column:
        usual = F.col(f"_at.{_path(rule)}")
        if rule.name not in elsewhere:
            return usual
        condition, path = elsewhere[rule.name]
        return F.when(condition, F.col(f"_at.{path}")).otherwise(usual)

    raw = pinned(walked, own, {f"_raw_{r.name}": located(r) for r in rules})
    kinds = {f"_kind_{r.name}": F.schema_of_variant(F.col(f"_raw_{r.name}")) for r in rules}
    read = pinned(raw, raw.columns, kinds)
    values = {
        r.name: _value(r, F.col(f"_kind_{r.name}"), F.col(f"_raw_{r.name}")).try_cast(f.dataType)
        for r, f in zip(rules, contract_schema(tuple(rules)))
    }
    typed = pinned(read, raw.columns, values, per_step=_FIELDS_PER_STEP)
    texts = {}
    for at in range(0, len(rules), _CHECKS_PER_STEP):
        some = rules[at : at + _CHECKS_PER_STEP]
        codes = [_problem(r, F.col(f"_raw_{r.name}")) for r in some]
        texts[f"_problems_{at}"] = F.nullif(F.concat_ws(_SEPARATOR, *codes), F.lit(""))
    found = pinned(typed, [*own, *values], texts, per_step=1)
    listed = F.concat_ws(_SEPARATOR, *texts)
    return found.withColumn("_listed", listed).select(
        *own,
        *values,
        F.when(F.col("_listed") != "", F.split("_listed", _SEPARATOR))
        .otherwise(F.array().cast("array<string>"))
        .alias("problems"),
    )


def validate_audits(df: DataFrame, *, record: str = "record") -> DataFrame:
    """Validate prediction audits. The contract is closed, so unknown keys are problems too.

    Adds the audit columns and ``error`` (NULL when valid).
    """
    known = F.array(*[F.lit(r.name) for r in AUDIT_RULES])
    extra = F.array_sort(F.array_except(jv.object_keys(F.col(record)), known))
    unknown = F.transform(extra, lambda k: F.concat(k, F.lit(":unknown")))
    problems = F.concat("problems", F.coalesce(unknown, F.array().cast("array<string>")))
    checked = validate_record(df, AUDIT_RULES, record=record)
    kept = [c for c in checked.columns if c != "problems"]
    listed = pinned(checked, kept, {"problems": problems})
    error = F.when(
        F.size("problems") > 0,
        F.when(~jv.is_object(F.col(record)), F.lit("not_an_object")).otherwise(
            F.array_join("problems", "; ")
        ),
    )
    return pinned(listed, kept, {"error": error})

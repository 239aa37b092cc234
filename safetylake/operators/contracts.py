"""Strict checks of stage outputs held as JSON text, as column expressions over whole tables.

A contract lists the fields of an object. Unknown fields, absent required fields, values
outside an enumeration or range and values of the wrong type are reported with their path.
Numbers and truth values may also be given as text, as the reference contracts allow.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safetylake import schemas as S


@dataclass(frozen=True)
class Field:
    kind: str  # string, bool, int, number, unit (0..1), enum, object, list
    required: bool = False
    nullable: bool = False
    values: tuple[str, ...] = ()
    fields: dict[str, Field] | None = None
    items: Field | None = None
    open: bool = False  # an object that may hold further fields
    low: float | None = None
    high: float | None = None


def _req(kind: str, **kw) -> Field:
    return Field(kind, required=True, **kw)


def _opt(kind: str, **kw) -> Field:
    return Field(kind, nullable=True, **kw)


def _enum(values: list[str], required: bool = True, nullable: bool = False) -> Field:
    return Field("enum", required=required, nullable=nullable, values=tuple(values))


def _obj(**fields: Field) -> Field:
    return Field("object", required=True, fields=fields)


def _list(items: Field) -> Field:
    return Field("list", items=items)


# --- Fixed values: fields of the stage outputs ---------------------------------------
_PRODUCT = _obj(
    name=_req("string"), manufacturer=_opt("string"), dose_series=_opt("string"),
    route=_opt("string"), role=_enum(S.PRODUCT_ROLE),
)
_EVENT = _obj(
    verbatim=_req("string"), onset_date=_opt("string"),
    outcome=_enum(S.OUTCOME, required=False, nullable=True),
)
_CASE = _obj(
    patient=_obj(age_years=_opt("number"), sex=_enum(S.SEX)),
    products=_list(_PRODUCT),
    events=_list(_EVENT),
    vaccination_date=_opt("string"),
    onset_date=_opt("string"),
    days_to_onset=_opt("int"),
    concomitant_meds=_list(Field("string")),
    medical_history=_list(Field("string")),
    allergies=_list(Field("string")),
)
_CODED = _obj(
    verbatim=_req("string"), meddra_pt=_req("string"), meddra_version=_opt("string"),
    confidence=_req("unit"), requires_review=Field("bool"),
)
_CODING = _obj(coded=_list(_CODED), uncoded=_list(Field("string")))
_SERIOUSNESS = _obj(serious=_req("bool"), criteria_met=_list(_enum(S.SERIOUSNESS)))
_CAUSALITY = _obj(
    method=_enum(S.CAUSALITY_METHOD), category=_enum(S.CAUSALITY_CATEGORY),
    score=_opt("number"), rationale=_req("string"),
)
_SIGNAL_ROW = Field(
    "object", required=True, open=True,
    fields={
        "event_pt": _req("string"), **{n: Field("int") for n in ("a", "b", "c", "d", "n_total")},
        "prr": _opt("number"), "ror": _opt("number"), "signal_flag": Field("bool"),
    },
)
CONTRACTS = {
    "triage": _obj(
        valid=_req("bool"),
        missing_criteria=_list(_enum(S.VALIDITY)),
        seriousness_screen=_obj(
            serious=_req("bool"), criteria_flagged=_list(_enum(S.SERIOUSNESS))
        ),
        priority=_enum(S.PRIORITY),
        confidence=_req("unit"),
        rationale=_opt("string"),
    ),
    "extraction": _obj(case=_CASE, confidence=_req("unit")),
    "coding": _obj(result=_CODING, confidence=_req("unit")),
    "assessment": _obj(seriousness=_SERIOUSNESS, causality=_CAUSALITY, confidence=_req("unit")),
    "narrative_qc": _obj(
        narrative=_req("string"),
        completeness=_obj(completeness_score=_req("unit"), gaps=_list(Field("string"))),
        qc_flags=_list(
            _obj(type=_enum(S.QC_TYPE), severity=_enum(S.QC_SEVERITY), detail=_opt("string"))
        ),
        overall_confidence=_req("unit"),
        hitl_recommended=_req("bool"),
    ),
    "signal": _obj(
        generated_sql=_req("string"), results=_list(_SIGNAL_ROW), summary=_req("string"), caveats=_list(Field("string")),
    ),
    "assembled_case": _obj(
        run_id=_req("string"), vaers_id=_req("string"), pipeline_version=Field("string"), extracted=_CASE,
        coded_pts=Field("list", required=True, items=Field("string")), coded_detail=Field("object", fields=_CODING.fields),
        seriousness=_SERIOUSNESS, causality=_CAUSALITY, narrative=_req("string"), overall_confidence=_req("unit"),
        hitl_required=_req("bool"),
    ),
    "case": _CASE,
    "coding_result": _CODING,
    "seriousness": _SERIOUSNESS,
    "causality": _CAUSALITY,
}
TRUTH_WORDS = ["true", "false", "t", "f", "yes", "no", "y", "n", "on", "off", "0", "1", "0.0", "1.0"]

_NO_ERRORS = "array<string>"


def _none() -> Column:
    return F.array().cast(_NO_ERRORS)


def _say(path: str, words: str) -> Column:
    return F.array(F.lit(f"{path}: {words}"))


def _unless(ok: Column, path: str, words: str) -> Column:
    return F.when(F.coalesce(ok, F.lit(False)), _none()).otherwise(_say(path, words))


def _check(root: Column, at: str, field: Field, path: str) -> Column:
    """Errors of the present, non-null value at the JSON path ``at`` of a variant."""

    def typed(kind: str) -> Column:
        return F.try_variant_get(root, at, kind)

    if field.kind == "string":
        return _unless(F.schema_of_variant(typed("variant")) == "STRING", path, "not text")
    if field.kind == "enum":
        return _unless(typed("string").isin(list(field.values)), path, "not in list")
    if field.kind == "bool":
        return _unless(F.lower(typed("string")).isin(TRUTH_WORDS), path, "not a truth value")
    if field.kind in ("int", "number", "unit"):
        number = typed("double")
        verdict = F.when(number.isNull(), _say(path, "not a number"))
        if field.kind == "int":
            verdict = verdict.when(number != F.floor(number), _say(path, "not whole"))
        low, high = (0.0, 1.0) if field.kind == "unit" else (field.low, field.high)
        if low is not None:
            verdict = verdict.when(number < low, _say(path, "out of range"))
        if high is not None:
            verdict = verdict.when(number > high, _say(path, "out of range"))
        return verdict.otherwise(_none())
    if field.kind == "list":
        items = typed("array<variant>")
        inner = F.transform(items, lambda v: _value_errors(v, "$", field.items, f"{path}[]"))
        return F.coalesce(F.flatten(inner), _say(path, "not a list"))
    return _object_errors(root, at, field, path)


def _value_errors(root: Column, at: str, field: Field, path: str) -> Column:
    """Errors of a value that may be absent or a JSON null."""
    value = F.try_variant_get(root, at, "variant")
    absent = _say(path, "missing") if field.required else _none()
    null = _none() if field.nullable else _say(path, "null")
    return (
        F.when(value.isNull(), absent)
        .when(F.is_variant_null(value), null)
        .otherwise(_check(root, at, field, path))
    )


def _object_errors(root: Column, at: str, contract: Field, path: str) -> Column:
    prefix, fields = f"{path}." if path else "", contract.fields
    names = F.map_keys(F.try_variant_get(root, at, "map<string,variant>"))
    unknown = F.transform(
        F.array_except(names, F.array(*[F.lit(n) for n in fields])),
        lambda name: F.concat(F.lit(prefix), name, F.lit(": unknown field")),
    )
    found = ([] if contract.open else [unknown]) + [
        _value_errors(root, f"{at}.{name}", field, prefix + name) for name, field in fields.items()
    ]
    no_object = F.array(F.lit(f"{path}: not an object" if path else "not an object"))
    return F.when(names.isNull(), no_object).otherwise(F.concat(_none(), *found))


def contract_errors(value: Column, contract: str | Field) -> Column:
    """Sorted distinct errors of one output, given as a variant column; empty when sound.

    ``contract`` is a name of CONTRACTS or what ``compile_schema`` made of a registry.
    """
    contract = CONTRACTS[contract] if isinstance(contract, str) else contract
    errors = F.when(value.isNull(), F.array(F.lit("not JSON"))).otherwise(_object_errors(value, "$", contract, ""))
    return F.array_sort(F.array_distinct(errors))


def compile_schema(schema: dict, registry: dict, required: bool = True) -> Field:
    """A contract from a JSON schema, as stage registries hold them.

    Read are types (a list of types may hold "null"), enumerations, ranges of numbers, items, properties, required
    ones, additionalProperties (allowed unless it is false) and references (``#/...``) into ``registry``. Other
    words, such as descriptions, check nothing. A schema that contains itself cannot be compiled.
    """

    def resolved(node: dict, seen: tuple[str, ...]) -> tuple[dict, tuple[str, ...]]:
        while "$ref" in node:
            ref = node["$ref"]
            if ref in seen:
                raise ValueError(f"{ref} contains itself")
            seen, node = (*seen, ref), registry
            for step in ref.removeprefix("#/").split("/"):
                if step not in node:
                    raise ValueError(f"{ref} is not in the registry")
                node = node[step]
        return node, seen

    def made(node: dict, is_required: bool, seen: tuple[str, ...]) -> Field:
        node, seen = resolved(node, seen)
        kinds = node.get("type", "string" if "enum" in node else "object")
        kinds = [kinds] if isinstance(kinds, str) else list(kinds)
        values = tuple(v for v in node.get("enum", ()) if v is not None)
        common = {"required": is_required, "nullable": "null" in kinds or None in node.get("enum", ())}
        plain = [k for k in kinds if k != "null"]
        if len(plain) != 1:
            raise ValueError(f"one type besides null is needed, not {kinds}")
        if values:
            return Field("enum", values=values, **common)
        if plain[0] == "object":
            needed = node.get("required", [])
            fields = {name: made(inner, name in needed, seen) for name, inner in node.get("properties", {}).items()}
            return Field("object", fields=fields, open=node.get("additionalProperties", True) is not False, **common)
        if plain[0] == "array":
            return Field("list", items=made(node["items"], True, seen), **common)
        if plain[0] in ("number", "integer"):
            low, high = node.get("minimum"), node.get("maximum")
            return Field("int" if plain[0] == "integer" else "number", low=low, high=high, **common)
        return Field({"boolean": "bool", "string": "string"}[plain[0]], **common)

    return made(schema, required, ())


def drift(old: Field, new: Field, path: str = "") -> list[str]:
    """What two versions of a contract disagree in, with the path of each field."""
    here = path or "$"
    found = []
    kinds = {"unit": "number"}
    if kinds.get(old.kind, old.kind) != kinds.get(new.kind, new.kind):
        return [f"{here}: {old.kind} became {new.kind}"]
    for name in ("required", "nullable", "open"):
        if getattr(old, name) != getattr(new, name):
            found.append(f"{here}: {'now' if getattr(new, name) else 'no longer'} {name}")
    ranges = [(0.0, 1.0) if f.kind == "unit" else (f.low, f.high) for f in (old, new)]
    if ranges[0] != ranges[1]:
        found.append(f"{here}: range changed")
    if set(old.values) != set(new.values):
        found.append(f"{here}: values changed")
    if old.items and new.items:
        found += drift(old.items, new.items, f"{here}[]")
    a, b = old.fields or {}, new.fields or {}
    below = lambda name: f"{path}.{name}" if path else name
    found += [f"{below(n)}: removed" for n in a if n not in b] + [f"{below(n)}: added" for n in b if n not in a]
    for name in a:
        if name in b:
            found += drift(a[name], b[name], below(name))
    return sorted(found)


def validate(outputs: DataFrame, column: str, contract: str | Field) -> DataFrame:
    """Adds errors and valid; split the result on ``valid`` into good rows and quarantine.

    The text is parsed in a projection of its own, once per row however many fields are checked.
    """
    parsed = outputs.withColumn("_json", F.try_parse_json(column))
    return (
        parsed.withColumn("errors", contract_errors(F.col("_json"), contract))
        .withColumn("valid", F.size("errors") == 0)
        .drop("_json")
    )


def parse(outputs: DataFrame, column: str, stage: str) -> DataFrame:
    """Valid outputs as the stage's struct column, absent lists as empty ones."""
    value = F.try_variant_get(
        F.try_parse_json(F.col(column)), "$", S.STAGE_OUTPUT[stage].simpleString()
    )
    return outputs.withColumn(stage, value).withColumn(stage, _defaults(F.col(stage), CONTRACTS[stage].fields))


def _defaults(value: Column, fields: dict[str, Field]) -> Column:
    columns = []
    for name, field in fields.items():
        item = value[name]
        if field.kind == "object":
            item = _defaults(item, field.fields)
        elif field.kind == "list" and field.items.kind == "object":
            inner = field.items.fields
            item = F.coalesce(F.transform(item, lambda v: _defaults(v, inner)), F.array())  # noqa: B023
        elif field.kind == "list":
            item = F.coalesce(item, _none())
        elif field.kind == "bool" and not field.required:
            item = F.coalesce(item, F.lit(False))
        columns.append(item.alias(name))
    return F.struct(*columns)

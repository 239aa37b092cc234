"""Contracts compiled from a schema registry, drift between versions, and halving of failing batches."""

import json

import pytest

from safetylake.operators import contracts
from safetylake.plans import catalog
from safetylake.plans.predict import in_halves

REGISTRY = {
    "$defs": {
        "Share": {"type": "number", "minimum": 0, "maximum": 1},
        "Item": {
            "type": "object", "additionalProperties": False, "required": ["name"],
            "properties": {"name": {"type": "string"}, "kind": {"enum": ["a", "b", None]}, "share": {"$ref": "#/$defs/Share"}},
        },
        "Loop": {"type": "object", "properties": {"next": {"$ref": "#/$defs/Loop"}}},
    },
    "out": {
        "type": "object", "required": ["items", "n"],
        "properties": {
            "items": {"type": "array", "items": {"$ref": "#/$defs/Item"}}, "n": {"type": ["integer", "null"], "minimum": 2},
            "ok": {"type": "boolean", "description": "checks nothing"},
        },
    },
}


def errors(spark, contract, *values):
    rows = [(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "i int, output string")
    return [list(r.errors) for r in contracts.validate(frame, "output", contract).orderBy("i").collect()]


def test_compiled_registry(spark):
    contract = contracts.compile_schema(REGISTRY["out"], REGISTRY)
    item = {"name": "x", "kind": None, "share": 0.5}
    assert errors(
        spark, contract,
        {"items": [item], "n": 2, "ok": True, "more": 1}, {"items": [], "n": None}, {"n": 1.5}, {"items": [item], "n": 1},
        {"items": [{**item, "share": 2, "kind": "c", "x": 1}, {}], "n": 3, "ok": "maybe"}, {"items": None, "n": 2}, [], "{",
    ) == [
        [], [], ["items: missing", "n: not whole"], ["n: out of range"],
        ["items[].kind: not in list", "items[].name: missing", "items[].share: out of range", "items[].x: unknown field", "ok: not a truth value"],
        ["items: null"], ["not an object"], ["not JSON"],
    ]
    with pytest.raises(ValueError, match="contains itself"):
        contracts.compile_schema(REGISTRY["$defs"]["Loop"], REGISTRY)
    with pytest.raises(ValueError, match="not in the registry"):
        contracts.compile_schema({"$ref": "#/$defs/Other"}, REGISTRY)
    with pytest.raises(ValueError, match="one type"):
        contracts.compile_schema({"type": ["string", "number"]}, REGISTRY)


def test_drift_between_versions():
    old = contracts.compile_schema(REGISTRY["out"], REGISTRY)
    assert contracts.drift(old, old) == []
    later = json.loads(json.dumps(REGISTRY))
    item = later["$defs"]["Item"]
    item["properties"]["kind"]["enum"] = ["a", "b", "c"]
    item["properties"]["size"] = {"type": "integer"}
    item["required"] = []
    del later["out"]["properties"]["ok"]
    later["out"]["properties"]["n"] = {"type": "string"}
    later["$defs"]["Share"]["maximum"] = 2
    assert contracts.drift(old, contracts.compile_schema(later["out"], later)) == sorted([
        "items[].kind: no longer nullable", "items[].kind: values changed", "items[].name: no longer required",
        "items[].share: range changed", "items[].size: added", "n: int became string", "ok: removed",
    ])


def test_samples_of_all_contracts_are_sound(spark):
    for name, (sound, faults) in catalog.SAMPLES.items():
        found = errors(spark, name, sound, *[sound.replace(old, new, 1) for old, new in faults])
        assert found[0] == [] and all(found[1:]), name


@pytest.mark.parametrize("bad", [set(), {0}, {2731}, {4095}, {7, 8, 3000}])
def test_a_bad_row_costs_two_calls_for_each_halving(bad):
    calls = []

    def call(texts):
        calls.append(len(texts))
        if any(int(t) in bad for t in texts):
            raise ValueError(f"cannot read {len(texts)}")
        return [(t, None, 0, 0, 0) for t in texts]

    results = in_halves(call, [str(i) for i in range(4096)])
    assert [(r[0], r[1]) for r in results] == [(None, "cannot read 1") if i in bad else (str(i), None) for i in range(4096)]
    assert len(calls) <= 1 + 24 * len(bad)
    assert in_halves(call, [str(min(bad, default=1))])

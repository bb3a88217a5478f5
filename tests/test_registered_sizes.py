"""Registered queries run the operators' whole default job."""

import pytest

from parasynth.catalogue import queries


class Called(Exception):
    pass


@pytest.mark.parametrize("name, module, operator", [
    ("noise_grid", queries.optimize, "noise_grid"), ("tstr_metrics", queries.benchmark, "tstr"), ("synth_by_source", queries.synthesize, "synthesize_many"),
])
def test_no_smaller_job_than_the_defaults(monkeypatch, name, module, operator):
    def called(*inputs, **others):
        raise Called(inputs, others)

    monkeypatch.setattr(queries.inputs, "merged_by_nation", lambda *_: ("v", "c", "m"))
    monkeypatch.setattr(queries.inputs, "supplier_profile", lambda *_: ("v", "c"))
    monkeypatch.setattr(queries, "_quality_spec", lambda *_: "spec")
    monkeypatch.setattr(module, operator, called)
    with pytest.raises(Called) as got:
        queries.QUERIES[name](None, "")
    assert got.value.args == ((("spec",) if operator == "tstr" else ("v", "c")), {})

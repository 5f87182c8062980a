"""The registered searches run their whole number of draws, over all families, and are searched once."""

import pytest

from ferrite import queries as Q
from ferrite.plans import training as TR


class _Prepared:
    def part(self, name):
        return name


def test_draws_and_spaces():
    assert Q.DRAWS == {"lr": 20, "rf": 20, "gbt": 20, "mlp": 10}
    for kind, n in Q.DRAWS.items():
        space = Q.M.SEARCH_SPACES[kind]
        cells = 1
        for v in space.values():
            cells *= len(v)
        draws = Q.M.sample_param_maps(space, n)
        assert len(draws) == min(n, cells) and len({str(d) for d in draws}) == len(draws)


@pytest.mark.parametrize("name, kind", [("q_random_search", "lr"), ("q_random_search_rf", "rf"), ("q_random_search_gbt", "gbt"), ("q_mlp_search", "mlp")])
def test_searches_go_through_the_registry(monkeypatch, name, kind):
    seen = []
    monkeypatch.setattr(Q, "_made_from", lambda spark, sf, *more: [sf, *more])
    monkeypatch.setattr(Q, "prepared", lambda spark, sf: "prepared")
    monkeypatch.setattr(Q.TR, "search_draws", lambda p, k, n: seen.append((p, k, n)) or "table")
    monkeypatch.setattr(Q.registry, "stored_table", lambda spark, entry, made_from, make: (entry, made_from, make()))
    entry, made_from, table = getattr(Q, name)(None, "sf")
    assert (entry, table) == (f"draws-{kind}", "table") and seen == [("prepared", kind, Q.DRAWS[kind])]
    assert made_from == ["sf", Q.M.SEARCH_SPACES[kind], Q.DRAWS[kind]]


def test_final_selection_reads_all_families(monkeypatch):
    calls = {}
    monkeypatch.setattr(Q, "prepared", lambda spark, sf: _Prepared())
    monkeypatch.setattr(Q, "_draws", lambda spark, sf, kind: f"draws of {kind}")
    monkeypatch.setattr(Q.TR, "tuned_params", lambda draws, defaults: calls.update(draws=draws) or {"tuned": 1})
    monkeypatch.setattr(Q.TR, "threshold_tuning", lambda p, kinds, params: "tuning")
    monkeypatch.setattr(Q.TR, "stability", lambda p, kinds, params: calls.update(stable=kinds, params=params) or "stability")
    monkeypatch.setattr(Q.TR, "final_selection", lambda tuning, override, stable: (tuning, stable))
    assert Q.q_final_selection(None, "sf") == ("tuning", "stability")
    assert calls["draws"] == {k: f"draws of {k}" for k in ("lr", "rf", "gbt", "mlp")}
    assert calls["stable"] == ["lr", "rf", "gbt", "mlp"] and calls["params"] == {"tuned": 1}


def test_best_parameters_of_result_tables(spark):
    cv = spark.createDataFrame([(0, '{"C": 1}', 0.5), (1, '{"C": 10}', 0.7), (2, '{"C": 100}', 0.7)], "draw int, params string, cv_f1_mean double")
    val = spark.createDataFrame([(0, '{"units_1": 64}', 0.2)], "draw int, params string, validation_f1 double")
    got = TR.tuned_params({"lr": cv, "mlp": val}, {"lr": {"C": 3, "max_iter": 9}, "mlp": {"units_1": 1}, "rf": {"n_estimators": 5}})
    assert got == {"lr": {"C": 10, "max_iter": 9}, "mlp": {"units_1": 64}, "rf": {"n_estimators": 5}}

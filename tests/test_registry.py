from __future__ import annotations

import json

import pytest

from catalogue.fixtures import SETS_A
from lift.operators import registry as R

from conftest import as_tuples


@pytest.fixture
def everything(spark):
    return R.registry_from(spark, SETS_A)


def names(registry):
    return {one.name: list(one.features) for one in R.chosen_sets(registry)}


def test_default_registry(spark):
    sets = R.chosen_sets(R.default_registry(spark))
    assert [len(one.features) for one in sets] == [5, 5, 9, 10, 10]
    assert sets[2].source == "features_set3" and sets[2].features[8] == "set3_feature_8"


def test_json_is_one_array_and_comes_back_unchanged(spark, everything, tmp_path):
    path = str(tmp_path / "registry")
    R.save_registry(everything, path)
    text = "".join(part.read_text() for part in (tmp_path / "registry").glob("part-*"))
    assert json.loads(text) == [dict(one) for one in SETS_A]
    assert as_tuples(R.load_registry(spark, path)) == as_tuples(everything)


def test_plain_file_with_line_breaks_loads(spark, tmp_path):
    file = tmp_path / "top.json"
    file.write_text(json.dumps([dict(SETS_A[0]), dict(SETS_A[1])], indent=2))
    assert names(R.load_registry(spark, str(file))) == {one["name"]: one["features"] for one in SETS_A[:2]}


def test_merge_keeps_registry_order_and_drops_the_unknown(everything):
    one = R.convert_features(everything, ["set4_qty", "not_in_registry", "set1_order_cnt"])
    two = R.convert_features(everything, ["set4_qty", "set2_urgent"])
    assert names(R.merge_selections(everything, two, one)) == {"set1": ["set1_order_cnt"], "set2": ["set2_urgent"], "set4": ["set4_qty"]}


def test_choose_and_leave_out(everything):
    assert list(names(R.choose_sets(everything, "main"))) == ["set1", "set4", "set5"]
    assert list(names(R.choose_sets(everything, ["set4", "set2"]))) == ["set2", "set4"]
    assert list(names(R.choose_sets(everything, "set2"))) == ["set2"]
    left = names(R.leave_out(everything, "set1", [*SETS_A[1]["features"], "set4_qty"]))
    assert list(left) == ["set3", "set4", "set5"] and "set4_qty" not in left["set4"]


def test_a_name_is_not_matched_inside_another(spark):
    sets = [{"name": name, "class": "main", "type": "numerical", "source": name, "features": [f"{name}_f"]} for name in ("set1", "set10")]
    assert list(names(R.leave_out(R.registry_from(spark, sets), "set10"))) == ["set1"]

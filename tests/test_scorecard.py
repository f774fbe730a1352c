import pytest

from loamline.operators import dedup, metrics, projects

GOOD = {"malformed": 50, "yaml_short_share": 0.1, "largest_share": 0.45, "p95": 9000, "ambiguous_ratio": 0.01, "duplicate_ratio": 0.01, "empty_share": {"yaml": 0.01}, "coverage": {"di": 5}}
SCHEMA = "malformed long, yaml_short_share double, largest_share double, p95 long, ambiguous_ratio double, duplicate_ratio double, empty_share map<string,double>, coverage map<string,long>"


def failed(spark, need=("yaml", "other"), targets=None, **changed):
    row = tuple((GOOD | changed)[c.split(" ")[0]] for c in SCHEMA.split(", "))
    card = metrics.quality_checks(spark.createDataFrame([row], SCHEMA), 0.45, list(need), {"di": 5} if targets is None else targets)
    names = [r[0] for r in metrics.failed_checks(card).collect()]
    assert card.first()["overall_passed"] == (not names)
    return names


def test_limits_themselves_pass(spark):
    assert failed(spark) == [] and failed(spark, need=(), targets={}, empty_share={}, coverage={}) == []


@pytest.mark.parametrize(
    ("changed", "name"),
    [
        ({"malformed": 51}, "malformed_instruction_class_slot"), ({"yaml_short_share": 0.11}, "yaml_too_short_share"), ({"largest_share": 0.46}, "drupal_core_train_share"), ({"p95": 9001}, "train_output_p95"), ({"ambiguous_ratio": 0.02}, "ambiguous_pair_ratio"),
        ({"duplicate_ratio": None}, "normalized_output_duplicate_ratio"), ({"empty_share": {"other": 0.02}}, "empty_input_share_by_type"), ({"coverage": {}}, "weak_category_coverage"),
    ],
)
def test_each_check_alone(spark, changed, name):
    assert failed(spark, **changed) == [name]


def test_first_branch_with_a_file_decides(spark):
    core = '{"require": {"drupal/core": "^11", "php": ">=8.3"}, "require-dev": {"drupal/PHPUnit-x": "*"}}'
    rows = [("a", "2.x", 1, core), ("a", "1.x", 0, None), ("b", "1.x", 0, "{broken"), ("b", "2.x", 1, core), ("c", "1.x", 0, '{"require": [], "require-dev": []}'), ("d", "1.x", 0, '{"require": {"drupal/core": "", "drupal/core-recommended": "^10"}}'), ("e", "1.x", 0, "")]
    got = {r["machine_name"]: tuple(r)[1:] for r in projects.composer_metadata(spark.createDataFrame(rows, "machine_name string, branch string, place int, content string")).collect()}
    assert got == {"a": ("2.x", "^11", ">=8.3", True), "b": (None, None, None, None), "c": ("1.x", None, None, False), "d": ("1.x", "^10", None, False)}


def test_summary_of_copies(spark):
    files = spark.createDataFrame([("a", "four", "canonical"), ("b", "four", "exact"), ("c", None, "near")], "path string, content string, dup_type string")
    assert sorted(map(tuple, dedup.summary(files).collect())) == [("canonical", 1, 4, 0), ("exact", 1, 4, 4), ("near", 1, 0, 0)]

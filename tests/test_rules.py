import pytest

from dewpoint.operators import clean_rules, default_rules, load_rules, read_rules


def test_read(spark, rule_file):
    rules = read_rules(spark, rule_file)
    assert dict(rules.dtypes) == {
        "id": "int",
        "humidity_min": "double",
        "humidity_max": "double",
        "temperature_min": "double",
        "temperature_max": "double",
        "code": "string",
        "message": "string",
    }
    assert rules.filter("id = 3").first().temperature_min == -300.0
    assert rules.filter("id = 1").first().temperature_min == -999.0


def test_sentinel_becomes_null_and_other_bounds_stay(spark, rule_file):
    rows = {r.code: r for r in load_rules(spark, rule_file).collect()}
    assert rows["101"][1:5] == (0.0, 40.0, None, None)
    assert rows["103"][1:5] == (None, None, -300.0, 30.0)
    assert rows["104"].message == "It's too hot"


def test_default_rules_are_the_shipped_file(spark, rule_file):
    assert default_rules(spark).collect() == load_rules(spark, rule_file).collect()


def test_other_sentinel(spark, rule_file):
    rules = clean_rules(read_rules(spark, rule_file), sentinel=-300)
    assert rules.filter("id = 3").first().temperature_min is None
    assert rules.filter("id = 1").first().temperature_min == -999.0


def test_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(
        "message,code,temperature_max,temperature_min,humidity_max,humidity_min,id\n"
        'warm,"E7",30.5,20,,-999,1\n'
    )
    row = load_rules(spark, str(path)).first()
    assert tuple(row) == (1, None, None, 20.0, 30.5, "E7", "warm")


def test_text_in_a_bound_is_an_error(spark, tmp_path):
    path = tmp_path / "r.csv"
    path.write_text(
        "id,humidity_min,humidity_max,temperature_min,temperature_max,code,message\n"
        "1,low,40,-999,-999,101,dry\n"
    )
    with pytest.raises(Exception, match="humidity_min is not a number: low"):
        read_rules(spark, str(path)).collect()


HEADER = "id,humidity_min,humidity_max,temperature_min,temperature_max,code,message\n"


def _codes(spark, tmp_path, lines, **options):
    path = tmp_path / "rules.csv"
    path.write_text(HEADER + lines)
    return [r.code for r in read_rules(spark, str(path), **options).orderBy("id").collect()]


@pytest.mark.parametrize(
    "lines",
    ["1,0,40,-999,-999,101,dry\n2,60\n", '1,0,40,-999,-999,101,"too\ndry"\n', "1,0,40,-999,-999,,dry\n"],
    ids=["a short line", "a line break in a message", "no code"],
)
def test_broken_lines_stop_the_read(spark, tmp_path, lines):
    with pytest.raises(Exception):
        _codes(spark, tmp_path, lines)


def test_line_breaks_may_be_allowed(spark, tmp_path):
    lines = '1,0,40,-999,-999,101,"too\ndry"\n'
    assert _codes(spark, tmp_path, lines, multi_line=True) == ["101"]


def test_codes_keep_their_text(spark, tmp_path):
    mixed = "1,0,40,-999,-999,007,dry\n2,0,40,-999,-999,A1,dry\n"
    assert _codes(spark, tmp_path, mixed) == ["007", "A1"]
    assert _codes(spark, tmp_path, mixed.replace("A1", "12")) == ["7", "12"]

from coursemill.sources.lines import json_fields, tsv_fields
from tests.conftest import plan


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_only_json_objects_are_kept(spark, rows):
    df = lines(spark, '{"a":1,"b":"x"}', "bad", "[1]", '[{"a":2}]', "null", "", None, "{}", '{"a":', '\t{"a":"3"}', "{a:'q'}")
    assert rows(json_fields(df, ["a", "b"])) == [(None, None), ("1", "x"), ("3", None), ("q", None)]


def test_nothing_may_follow_the_object(spark, rows):
    tails = ["xyz", "]", '{"a":2}', ',"a":2', ',{"a":2}', ',"q":{"b":2}', '],"q":[{"b":1}', '],[{"a":2}', "]]", ']],[[{"a":2}', "}", ",", '],[{"_line_mark":"1"}]']
    df = lines(spark, *[f'{{"a":1}}{t}' for t in tails], '{"a":7} \t')
    assert rows(json_fields(df, ["a"])) == [("7",)]


def test_cut_lines_never_reach_the_parser(spark, rows):
    df = json_fields(lines(spark, '{"a":"}"', '{"a":1', '{"a":1} xyz', '{"a":4}\r\n', ' {"a":5} \t'), ["a"])
    assert "EndsWith(rtrim(value" in plan(df)
    assert rows(df) == [("4",), ("5",)]


def test_nested_values_come_as_text(spark, rows):
    df = lines(spark, '{"a":{"x":1},"b":[1,2]}')
    assert rows(json_fields(df, ["a", "b"])) == [('{"x":1}', "[1,2]")]


def test_each_line_is_parsed_once(spark):
    df = json_fields(lines(spark, "{}"), ["a", "b", "c"])
    assert plan(df).count("from_json(") == 1


def test_tsv_arity_ignores_trailing_empty_fields(spark, rows):
    df = lines(spark, "a\tb\tc", "a\tb", "a\tb\tc\td", "a\tb\t", "a\tb\tc\t\t", "a\t\tc", "", None)
    assert rows(tsv_fields(df, ["x", "y", "z"])) == [("a", "", "c"), ("a", "b", "c"), ("a", "b", "c")]

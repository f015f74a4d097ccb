from conftest import rows

from signalloom.model import struct_of
from signalloom.sources import discovery

SCHEMA = struct_of("id STRING, n INT")
LINES = [
    '{"id": "1", "n": 2, "a": 1, "b": null, "c": "x", "d": 1.5}',
    '{"id": "2", "a": 20000000000, "b": null, "c": 7, "d": 2, "e": {"x": 1}}',
    '{"id": "3", "a": null, "d": 2.25, "it\'s": true, "e": {"x": "t"}}',
    "not json", "[1, 2]", "7", "", None, '{"unclosed": 1',
]


def lines(spark, data=LINES):
    return spark.createDataFrame([(i, v) for i, v in enumerate(data)], "i INT, value STRING")


def test_report_names_types_and_counts(spark):
    found = rows(discovery.unknown_fields(lines(spark).repartition(4), SCHEMA), "field", "type", "n_rows", "n_nulls")
    assert found == [
        ("a", "BIGINT", 3, 1), ("b", "VOID", 2, 2), ("c", "VARIANT", 2, 0), ("d", "DECIMAL(22,2)", 3, 0),
        ("e", "OBJECT<x: VARIANT>", 2, 0), ("it's", "BOOLEAN", 1, 0),
    ]
    assert discovery.unknown_fields(lines(spark, []), SCHEMA).isEmpty()


def test_promotion_takes_frequent_fields_and_never_fails(spark):
    report = discovery.unknown_fields(lines(spark), SCHEMA)
    kinds = discovery.promotable(report)
    assert kinds == {"d": "DOUBLE", "a": "BIGINT", "c": "STRING", "e": "STRING", "it's": "BOOLEAN"}
    assert list(discovery.promotable(report, least_rows=3)) == ["d"]
    assert list(discovery.promotable(report, most=2)) == ["d", "a"]
    wide = discovery.promoted(lines(spark), kinds)
    found = rows(wide.where("i < 3"), "i", "a", "c", "d", "e", "it's")
    assert found == [(0, 1, "x", 1.5, None, None), (1, 20000000000, "7", 2.0, '{"x":1}', None), (2, None, None, 2.25, '{"x":"t"}', True)]
    assert rows(wide.where("i >= 3"), "a", "c", "d", "e", "it's") == [(None,) * 5] * 6
    # A type that a later line breaks gives null, not an error.
    assert rows(discovery.promoted(lines(spark), {"c": "BIGINT"}).where("i < 2"), "c") == [(7,), (None,)]

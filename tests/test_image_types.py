"""Image types learnt from variant images."""

import json

from rowtide.operators import shape


def test_types_are_merged_field_by_field(spark):
    images = [("d", "t", {"id": 1, "a": None, "x": 1}), ("d", "t", {"id": 2, "a": None, "x": 1.25, "new": [1, 2]}), ("d", "t", {}),
              ("d", "u", {"id": "k", "both": 1, "deep": {"p": True}}), ("d", "u", {"id": "l", "both": "s", "deep": {"q": 2}})]
    rows = [(json.dumps({"binlog": f"b.1:{i}", "db": d, "table": t, "event_type": "insert", "before": {}, "after": a, "timestamp": 1}),)
            for i, (d, t, a) in enumerate(images)] + [("#garbled",)]
    parsed = shape.parse_envelope_variant(spark.createDataFrame(rows, "value string"))
    types = {(r["db"], r["table"]): spark.createDataFrame([], f"i {r['image']}").schema["i"].dataType for r in shape.image_types(parsed).collect()}
    t, u = types["d", "t"], types["d", "u"]
    assert t.fieldNames() == ["a", "id", "new", "x"] and t["a"].dataType.simpleString() == "string" and t["id"].dataType.simpleString() == "bigint"
    assert t["x"].dataType.simpleString().startswith("decimal") and t["new"].dataType.simpleString() == "array<bigint>"
    assert u["both"].dataType.simpleString() == "variant" and u["deep"].dataType.fieldNames() == ["p", "q"]
    typed = shape.typed_by_table(parsed, shape.image_types(parsed))["d", "t"].orderBy("binlog").collect()
    assert [(r.after.id, float(r.after.x), r.after.new) if r.after else None for r in typed] == [(1, 1.0, None), (2, 1.25, [1, 2]), None]
    assert shape.image_types(parsed.limit(0)).collect() == []

"""Artifacts: equal bytes from equal records, parts that make one text, and what a manifest tells."""

import json

import pytest
from pyspark.sql import functions as F

from daybook.operators import artifact

ROW = "id string, name string, raw map<string,string>, n int"
RECORDS = [(f"k{i:03d}", f"nämé \"{i}\"", {"z": "1", "a": str(i)}, None if i % 3 else i) for i in range(40)]


def text(path):
    return "".join(f.read_text() for f in sorted(path.glob("part-*")))


def test_equal_records_give_equal_bytes(spark, tmp_path):
    rows = spark.createDataFrame(RECORDS, ROW)
    assert artifact.write_artifact(rows, "id", str(tmp_path / "a"), "trails", "2026-05-01") == 40
    artifact.write_artifact(rows.orderBy(F.desc("n"), F.rand(3)).repartition(5), "id", str(tmp_path / "b"), "trails", "2026-05-01", records_a_part=9)
    assert text(tmp_path / "a") == text(tmp_path / "b") and len(list((tmp_path / "b").glob("part-*"))) > 1
    read = json.loads(text(tmp_path / "a"))
    assert list(read) == ["source", "watermark", "recordCount", "records"] and read["recordCount"] == len(read["records"]) == 40
    assert [r["id"] for r in read["records"]] == sorted(r[0] for r in RECORDS) and list(read["records"][3]) == ["id", "n", "name", "raw"] and read["records"][3]["raw"] == {"a": "3", "z": "1"}
    assert text(tmp_path / "a") == json.dumps(read, indent=2, ensure_ascii=False) + "\n"
    artifact.write_artifact(rows.limit(0), "id", str(tmp_path / "none"), "trails")
    assert json.loads(text(tmp_path / "none"))["records"] == []
    for bad in (rows.union(rows.limit(1)), rows.withColumn("id", F.lit(None).cast("string"))):
        with pytest.raises(ValueError):
            artifact.write_artifact(bad, "id", str(tmp_path / "bad"), "trails")


def test_manifest_tells_one_flipped_field(spark):
    rows = spark.createDataFrame([(i, "x" * (i % 5)) for i in range(500)], "id long, name string")
    flipped = rows.withColumn("name", F.when(F.col("id") == 77, "other").otherwise(F.col("name")))
    was, now = artifact.manifest(rows, "id", buckets=16), artifact.manifest(flipped.repartition(7), "id", buckets=16)
    told = artifact.changes(was, now).groupBy("change").count().collect()
    assert {r["change"]: r["count"] for r in told} == {"changed": 1, "unchanged": 15}
    assert {r.change for r in artifact.changes(was, artifact.manifest(rows.limit(0), "id")).collect()} == {"removed"}

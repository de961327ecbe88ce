"""Files against manifests, bundles and stages that are damaged or killed."""

import os

import pytest
from pyspark.sql import functions as F

from strainframe.sources import bundle, files, stages


def local(path) -> str:
    return str(path).removeprefix("file://")


def test_each_kind_of_damage_is_one_row(spark, tmp_path):
    at = f"file://{tmp_path}/x"
    names = ["a.txt", "d/b.txt", "d/e/c.txt", "g.txt", "h.txt"]
    entries = {r.path: (r.path, r.bytes, r.sha256) for r in files.put_all(spark.createDataFrame([(n, n.encode()) for n in names], "path string, content binary"), at).collect()}
    schema = files.ENTRY
    good = list(entries.values())
    assert {(r.path, r.problem) for r in files.checked(spark, at, spark.createDataFrame(good, schema)).collect()} == {(n, None) for n in names}
    content = bytearray(open(local(f"{at}/a.txt"), "rb").read())
    content[0] ^= 1
    open(local(f"{at}/a.txt"), "wb").write(content)
    os.truncate(local(f"{at}/d/b.txt"), 2)
    os.remove(local(f"{at}/g.txt"))
    odd = [("../a.txt", 1, "0" * 64), ("/a.txt", 1, "0" * 64), ("d\\b.txt", 1, "0" * 64), ("d/./b.txt", 1, "0" * 64), ("file:/x", 1, "0" * 64), (None, 1, "0" * 64), ("", 1, "0" * 64)]
    rows = [e for e in good if e[0] != "h.txt"] + [entries["d/e/c.txt"]] + odd
    got = sorted(((r.path, r.problem) for r in files.checked(spark, at, spark.createDataFrame(rows, schema)).collect()), key=str)
    want = [("a.txt", "digest_differs"), ("d/b.txt", "size_differs"), ("d/e/c.txt", "repeated"), ("d/e/c.txt", "repeated"), ("g.txt", "missing"), ("h.txt", "unlisted"), ("../a.txt", "escapes"), ("/a.txt", "not_relative"), ("d\\b.txt", "not_relative"), ("d/./b.txt", "escapes"), ("file:/x", "not_relative"), (None, "no_path"), ("", "no_path")]
    assert got == sorted(want, key=str)


def test_a_bundle_with_a_flipped_byte_is_refused(spark, tmp_path):
    at = f"file://{tmp_path}/b"
    bundle.write_bundle({"t": spark.range(50).toDF("k"), "u": spark.range(0).toDF("k")}, at)
    assert bundle.read_bundle(spark, at)["t"].count() == 50
    (name,) = [n for n in os.listdir(local(f"{at}/t")) if n.endswith(".parquet")][:1]
    path = local(f"{at}/t/{name}")
    raw = bytearray(open(path, "rb").read())
    raw[len(raw) // 2] ^= 1
    open(path, "wb").write(raw)
    os.remove(f"{os.path.dirname(path)}/.{name}.crc")
    assert [(r.path, r.problem) for r in bundle.bundle_problems(spark, at).collect()] == [(f"t/{name}", "digest_differs")]
    with pytest.raises(ValueError, match="digest_differs"):
        bundle.read_bundle(spark, at)


def test_killed_and_failed_stages(spark, tmp_path):
    at, calls = f"file://{tmp_path}/s", []

    def work():
        calls.append(1)
        return {"t": spark.range(5).toDF("k")}

    stages.staged(at, "one", work())  # killed before its file was written
    with pytest.raises(ValueError, match="not complete"):
        stages.stage_tables(spark, at, "one")
    done = stages.publish(at, "one", work)
    assert stages.publish(at, "one", work) == done and len(calls) == 2
    failed = stages.publish(at, "two", lambda: {"t": spark.range(5).select(F.raise_error(F.lit("no tool")).alias("k"))})
    assert failed["status"] == "failed" and "no tool" in failed["error"]
    with pytest.raises(ValueError, match="no tool"):
        stages.stage_tables(spark, at, "two")
    assert stages.publish(at, "two", work)["status"] == "complete" and stages.stage_tables(spark, at, "two")["t"].count() == 5
    files.put(f"{at}/one-{done['attempt']}", "t/more.txt", b"x")
    again = stages.publish(at, "one", work)  # a damaged stage is made anew
    assert again["attempt"] != done["attempt"] and stages.damage(spark, at, again).count() == 0

import random

import pytest

from tidewright.sources.framed import FramedLog, audit, encode, frames, log_rows


def read(spark, tmp_path, data, split):
    (tmp_path / "log").mkdir(exist_ok=True)
    (tmp_path / "log" / "a.wal").write_bytes(data)
    spark.dataSource.register(FramedLog)
    return spark.read.format("framed_log").option("path", str(tmp_path / "log")).option("splitBytes", split).load()


def test_read_after_all_queries_are_loaded(spark, tmp_path):
    import __spark_entry__

    assert __spark_entry__.queries()
    assert read(spark, tmp_path, encode(b"one") + encode(b""), 100).where("status = 'ok'").count() == 2


@pytest.mark.parametrize("split", [37, 100_000])
@pytest.mark.parametrize(
    ("kind", "want"),
    [("clean", (4, 0, 0, False, False)), ("garbage", (4, 9, 1, False, False)), ("corrupt", (3, 13 + 20, 1, False, False)), ("short", (4, 5, 0, True, False)), ("cut", (4, 13 + 10, 0, True, False)), ("version", (2, 0, 0, False, True)), ("nested", (4, 0, 0, False, False))],
)
def test_audit(spark, tmp_path, kind, want, split):
    rng = random.Random(kind)
    parts = [encode(rng.randbytes(20)) for _ in range(4)]
    if kind == "garbage":
        parts.insert(2, b"garbage!!")
    if kind == "corrupt":
        parts[1] = parts[1][:-1] + bytes([parts[1][-1] ^ 1])
    if kind == "short":
        parts.append(b"WAL1\x01")
    if kind == "cut":
        parts.append(encode(b"x" * 40)[: 13 + 10])
    if kind == "version":
        parts[2] = parts[2][:4] + b"\x02" + parts[2][5:]
    if kind == "nested":
        parts[1] = encode(encode(b"inner") * 3)
    found = read(spark, tmp_path, b"".join(parts), split)
    got = audit(found).first()
    assert (got.frames_ok, got.skipped_bytes, got.resyncs, got.truncated_tail, got.wrong_version) == want
    for width in (1, 64):  # ranges of the running maximum
        assert audit(found, width).collect() == [got]
    if kind == "clean":
        ok = frames(found).where("status = 'ok'").orderBy("offset").collect()
        assert [encode(bytes(r.payload)) for r in ok] == parts


def test_no_window_holds_a_file(spark, tmp_path):
    found = read(spark, tmp_path, b"".join(encode(bytes([i]) * 30) for i in range(40)), 64)
    plan = audit(found, 64)._jdf.queryExecution().optimizedPlan().toString()
    over_frames = [line for line in plan.splitlines() if "windowspecdefinition" in line and "offset" in line]
    assert over_frames
    assert all("_range" in line.split("windowspecdefinition")[1].split(",")[1] for line in over_frames)


def test_rows_of_a_log_with_a_broken_end(spark, tmp_path):
    import json

    from pyspark.sql import functions as F

    row = lambda i, t: encode(json.dumps({"instrument": i, "funding_time": t, "rate": 0.1}).encode())
    schema = "instrument STRING, funding_time BIGINT, rate DOUBLE"
    decode = lambda p: F.from_json(p.cast("string"), schema)
    data = row("a", 10) + row("b", 99) + row("c", 100) + encode(b"no json") + row("d", 50)[:-3] + b"junk" + row("e", 60) + row("f", 70)[:20]
    found = read(spark, tmp_path, data, 64)
    assert sorted(r.instrument for r in log_rows(found, decode, 10, 100).collect()) == ["a", "b", "e"]
    wrong = row("a", 10) + b"WAL1\x02" + row("b", 20)[5:] + row("c", 30)
    assert [r.instrument for r in log_rows(read(spark, tmp_path, wrong, 64), decode, 0, 100).collect()] == ["a"]

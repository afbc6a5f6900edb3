"""Landing files rolled by bytes, visible by manifest, merged when idle."""

import json
import os
import random

import pytest

from vitrine.session import scratch_path
from vitrine.sinks import rolled as R
from vitrine.streaming import landing as L


def _local(root):
    return root.removeprefix("file:")


def _land(spark, root, slices, limit):
    for i, lines in enumerate(slices):
        spark.createDataFrame([(x,) for x in lines], "value string").repartition(2).write.text(f"{root}/src/slice={i}")
        q = R.start_rolled(spark, L.line_stream(spark, f"{root}/src/*/*.txt"), f"{root}/zone", f"{root}/chk", limit, once=True)
        q.awaitTermination()
        assert q.exception() is None


@pytest.mark.parametrize("longest, limit", [(10, 20_000), (1000, 20_000), (1_000_000, 10_485_760)])
def test_files_are_full_but_for_the_last_of_each_task(spark, longest, limit):
    rng = random.Random(longest)
    total = 0
    lines = []
    while total < 6 * limit:
        lines.append("x" * rng.randrange(longest // 2, longest))
        total += len(lines[-1]) + 1
    root = scratch_path(spark, "roll")
    _land(spark, root, [lines], limit)
    files = R.committed(f"{root}/zone")
    sizes = sorted(size for size, _ in files.values())
    assert sum(sizes) == total and max(sizes) <= limit
    assert all(os.path.getsize(f"{_local(root)}/zone/{p}") == size for p, (size, _) in files.items())
    assert sum(s < 0.9 * limit for s in sizes) <= 8                                      # the last one of each task
    assert sorted(r.value for r in R.read_landed(spark, f"{root}/zone").collect()) == sorted(lines)


def test_small_files_of_idle_days_are_merged(spark):
    root, limit = scratch_path(spark, "idle"), 5000
    slices = [[f"{i}-{k}-" + "y" * 40 for k in range(30)] for i in range(5)]
    _land(spark, root, slices, limit)
    zone = f"{root}/zone"
    before = R.committed(zone)
    assert R.merge_idle(spark, zone, 3600, limit) == 0 and R.committed(zone) == before   # not idle yet
    gone = R.merge_idle(spark, zone, 0, limit)
    after = R.committed(zone)
    assert gone == len(before) > len(after) and sum(s < 0.9 * limit for s, _ in after.values()) <= 1
    want = sorted(x for s in slices for x in s)
    assert sorted(r.value for r in R.read_landed(spark, zone).collect()) == want
    assert {"year", "month", "day"} <= set(R.read_landed(spark, zone).columns)
    left = [f for _, _, names in os.walk(_local(zone)) for f in names if f.endswith(".txt") and not f.startswith(".")]
    assert len(left) == len(after)
    _land_again = [["late line"]]
    spark.createDataFrame([(x,) for x in _land_again[0]], "value string").write.text(f"{root}/src/slice=9")
    q = R.start_rolled(spark, L.line_stream(spark, f"{root}/src/*/*.txt"), zone, f"{root}/chk", limit, once=True)
    q.awaitTermination()
    assert sorted(r.value for r in R.read_landed(spark, zone).collect()) == sorted([*want, "late line"])


def test_commits_without_a_rename(spark, tmp_path, monkeypatch):
    """Final names at once; files of an attempt without a manifest are not seen; a replayed batch replaces its manifest."""
    import pyarrow as pa
    from pyarrow import fs
    root = str(tmp_path)

    def refuse(*_):
        raise OSError("no rename here")

    monkeypatch.setattr(os, "rename", refuse)
    monkeypatch.setattr(os, "replace", refuse)
    writer = R.RolledWriter(root, 100)
    batch = pa.RecordBatch.from_pydict({"value": ["a", "b"], "year": ["2024"] * 2, "month": ["01"] * 2, "day": ["02"] * 2})
    lost = writer.write(iter([batch]))
    assert R.committed(root) == {}
    writer.commit([writer.write(iter([batch])), None], 3)
    assert len(R.committed(root)) == 1
    again = writer.write(iter([batch]))
    writer.commit([again], 3)
    assert list(R.committed(root)) == [again.files[0][0]]
    writer.abort([lost], 4)
    assert not os.path.exists(f"{root}/{lost.files[0][0]}")
    assert json.load(open(f"{root}/_manifest/batch-{3:020d}.json"))["remove"] == []
    assert sorted(r.value for r in R.read_landed(spark, root).collect()) == ["a", "b"]
    assert R.read_landed(spark, str(tmp_path / "nothing")).count() == 0
    assert isinstance(R._store("file:/tmp/x")[0], fs.LocalFileSystem) and R._store("file:/tmp/x")[1] == "/tmp/x"

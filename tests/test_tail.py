"""Following files that grow: no line lost, none twice."""

import os
import random

import pytest

from tests.conftest import SF_SMALL
from vitrine.plans import queries as Q
from vitrine.session import scratch_path
from vitrine.sources import tail
from vitrine.sources.tail import LineTailReader, tail_stream


def _read(reader, start, end):
    out = []
    for p in reader.partitions(start, end):
        for batch in reader.read(p):
            out += [(r["value"], r["position"]) for r in batch.to_pylist()]
    return out


def _append(path, data, mode="ab"):
    with open(path, mode) as f:
        f.write(data)


@pytest.mark.parametrize("range_bytes, block", [(7, 5), (64, 1 << 20), (1, 3), (1 << 20, 4)])
def test_pieces_cut_anywhere_are_read_once(tmp_path, monkeypatch, range_bytes, block):
    """Half lines wait; ranges and blocks cut lines anywhere; a reader is made anew for every batch."""
    monkeypatch.setattr(tail, "_BLOCK", block)
    rng = random.Random(range_bytes)
    lines = ["é" * rng.randrange(0, 12) + rng.choice(["", "a", " x y "]) for _ in range(120)]
    data = "".join(x + rng.choice(["\n", "\r\n"]) for x in lines).encode()
    path, got, at, offset = str(tmp_path / "events.log"), [], 0, {"files": {}}
    while at < len(data):
        n = rng.randrange(1, 150)
        _append(path, data[at:at + n])
        at += n
        reader = LineTailReader(path, range_bytes)
        end = reader.latestOffset()
        got += _read(reader, offset, end)
        assert _read(reader, end, end) == []
        offset = end
    assert [v for v, _ in got] == lines
    assert [p for _, p in got] == sorted({p for _, p in got})


def test_rotation_and_truncation(tmp_path):
    path = str(tmp_path / "events.log")
    reader = LineTailReader(path, 10)
    zero = reader.initialOffset()
    assert reader.latestOffset() == zero                                   # no file yet
    _append(path, b"one\ntwo\nhal")
    a = reader.latestOffset()
    assert [v for v, _ in _read(reader, zero, a)] == ["one", "two"]
    _append(path, b"f\nlast without end")
    os.rename(path, path + ".1")                                           # rotated before it was read to its end
    _append(path, b"new one\n")
    b = reader.latestOffset()
    assert sorted(v for v, _ in _read(reader, a, b)) == ["half", "last without end", "new one"]
    _append(path, b"again\n", "wb")                                        # cut off and written anew, shorter
    c = reader.latestOffset()
    assert [v for v, _ in _read(reader, b, c)] == ["again"]
    _append(path, b"another first line that is longer\nx\n", "wb")         # and longer
    d = reader.latestOffset()
    assert [v for v, _ in _read(reader, c, d)] == ["another first line that is longer", "x"]
    _append(path, b"z\n")
    restarted = LineTailReader(path, 10)                                   # a restart plans from the offsets alone
    assert [v for v, _ in _read(restarted, d, restarted.latestOffset())] == ["z"]
    os.rename(path, str(tmp_path / "elsewhere"))
    with pytest.raises(FileNotFoundError):
        _read(reader, zero, d)


def test_pattern_and_schemes(tmp_path):
    for k in range(3):
        _append(str(tmp_path / f"p{k}.log"), f"line {k}\n".encode())
    reader = LineTailReader(str(tmp_path / "p*.log"), 100)
    assert sorted(v for v, _ in _read(reader, reader.initialOffset(), reader.latestOffset())) == ["line 0", "line 1", "line 2"]
    assert tail.local_path("file:///a/b") == "/a/b" == tail.local_path("file:/a/b")
    with pytest.raises(ValueError):
        tail.local_path("s3a://bucket/x")


def test_stream_over_a_restart(spark, tmp_path):
    path, out, chk = str(tmp_path / "events.log"), str(tmp_path / "out"), str(tmp_path / "chk")

    def start():
        return tail_stream(spark, path, 16).writeStream.format("parquet").option("checkpointLocation", chk).start(out)

    _append(path, b"a\nb\nhalf a li")
    query = start()
    try:
        query.processAllAvailable()
        assert sorted(r.value for r in spark.read.parquet(out).collect()) == ["a", "b"]
        _append(path, b"ne\n\nc\nd")
        query.processAllAvailable()
    finally:
        query.stop()
    _append(path, b"d\ne\n")
    query = start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    rows = spark.read.parquet(out).orderBy("position").collect()
    assert [r.value for r in rows] == ["a", "b", "half a line", "", "c", "dd", "e"] and {r.file for r in rows} == {"events.log"}


def test_growing_logs_end_with_the_whole_log(spark):
    """The producer of the registered query leaves half lines between slices and every line in the end."""
    from vitrine.sources.driver_events import noisy_event_log
    root = scratch_path(spark, "grow")
    ev = Q.events(spark, SF_SMALL)
    cut = 0
    for part in (*Q.arrival_slices(ev, 3), None):
        Q.append_to_logs(spark, root, part)
        for name in os.listdir(tail.local_path(root)):
            if name.endswith(".log"):
                with open(f"{tail.local_path(root)}/{name}", "rb") as f:
                    cut += f.read()[-1:] != b"\n"
    assert cut >= 3
    want = sorted(r.value for r in noisy_event_log(ev).collect())
    assert sorted(r.value for r in spark.read.text(f"{root}/*.log").collect()) == want

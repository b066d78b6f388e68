import json

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from grainmill.operators import compaction as K

SCHEMA = "file_id bigint, filepath string, attempt int, body string, rec_key string"


def line(key, text="t", **more):
    return json.dumps({"rec_key": key, "text": text, "source": "c4", "lang": "it"} | more)


def slow_bins(sizes, capacity):
    room, out = [], np.zeros(len(sizes), np.int64)
    for i in np.argsort(-np.asarray(sizes), kind="stable"):
        need = min(sizes[i], capacity)
        at = next((j for j, r in enumerate(room) if r >= need), len(room))
        if at == len(room):
            room.append(capacity)
        room[at] -= need
        out[i] = at
    return out


@given(st.lists(st.integers(0, 130), max_size=40))
def test_first_fit_decreasing(sizes):
    assert K.first_fit_decreasing(np.array(sizes, np.int64), 100).tolist() == slow_bins(sizes, 100).tolist()


def files(spark, bodies):
    return spark.createDataFrame([(i, f"f{i}", a, b, "clash") for i, (a, b) in enumerate(bodies)], SCHEMA)


BODIES = [
    (1, line(1) + "\n" + line("2", None) + "\r\n﻿" + line(3, "") + "\n" + line(4)[:-5]),
    (1, line(1) + "\n" + line("2", None) + "\r\n﻿" + line(3, "") + "\n" + line(4)[:-5]),  # a repeated row
    (2, line(1, "later")),
    (1, line("2", "with text") + "\nnull\n[]\n{}\nWARN 1\n" + line(True) + "\n" + line("x1") + "\n" + line(5.0) + "\n" + line(5.5) + "\n" + line(10**30)),
    (None, '{"text":"no key"}'),
    (1, None),
    (1, ""),
    (1, line(7, "a" * 5000)),
]


def test_compaction_keeps_each_record_once(spark, tmp_path):
    out = K.compact(files(spark, BODIES), str(tmp_path), target_bytes=300)
    got = {r.rec_key: r.text for r in out.collect()}
    assert out.count() == len(got)
    assert got == {1: "later", 2: "with text", 3: "", 5: "t", 7: "a" * 5000}
    assert not [p for p in tmp_path.iterdir() if p.name.startswith("_staging")]
    again = K.compact(files(spark, BODIES[:1]), str(tmp_path))  # replaces the committed state as a whole
    assert {r.rec_key for r in again.collect()} == {1, 2, 3}
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("current")] == ["current"]


def test_empty_table(spark, tmp_path):
    assert K.compact(files(spark, []), str(tmp_path)).count() == 0


def test_a_loss_is_not_committed(spark, tmp_path, monkeypatch):
    sums = iter([(1, 1), (0, None)])
    monkeypatch.setattr(K, "checksum", lambda _: next(sums))
    with pytest.raises(RuntimeError, match="lose or repeat"):
        K.compact(files(spark, BODIES[:1]), str(tmp_path))
    assert not list(tmp_path.iterdir())


def test_shards_share_no_bin(spark):
    listed = K.manifest(files(spark, [(1, line(i)) for i in range(40)]))
    bins = K.plan_bins(listed, 400, shard_files=10).toPandas()
    assert len(bins) == 40
    assert bins.groupby("bin").size().max() <= 6


def test_files_of_the_wanted_size(spark, tmp_path):
    """Bins are weighed by what survives, as it is stored: superseded copies and compression don't make files small."""
    import os

    draw = np.random.default_rng(1)
    texts = ["".join(map(chr, draw.integers(97, 123, 2000).tolist())) for _ in range(600)]
    old = [(1, "\n".join(line(k, "old" * 600) for k in range(i, i + 3))) for i in range(0, 600, 3)]
    new = [(2, "\n".join(line(k, texts[k]) for k in range(i, i + 2))) for i in range(0, 600, 2)]
    target = 200_000
    out = K.compact(files(spark, old + new), str(tmp_path), target_bytes=target)
    assert {r.rec_key: r.text for r in out.collect()} == dict(enumerate(texts))
    sizes = [p.stat().st_size for p in tmp_path.rglob("*.parquet")]
    assert max(sizes) < 1.5 * target
    assert sorted(sizes)[1] > 0.5 * target  # all but the last bin
    assert len(sizes) < 10
    assert os.listdir(tmp_path / "snapshots") == [K.snapshots.facts(spark, str(tmp_path))["snapshot"]]


def test_large_files_are_cut(spark, tmp_path):
    body = "\n".join(line(k, "x" * 90) for k in range(200))
    out = K.compact(files(spark, [(1, body), (1, body), (2, line(0, "new"))]), str(tmp_path), target_bytes=3000)
    assert out.count() == 200
    assert out.where("rec_key = 0").first().text == "new"
    assert len(list(tmp_path.rglob("*.parquet"))) > 1


def test_readers_never_find_the_table_missing(spark, tmp_path):
    """A reader polls while the table is replaced many times; it sees one whole state each time."""
    import threading

    from grainmill.sources import readers, snapshots

    path = str(tmp_path / "t")
    states, seen, done = [[10 * i + k for k in range(i + 1)] for i in range(12)], [], threading.Event()

    def put(i):
        new = snapshots.new_snapshot(path)
        spark.createDataFrame([(v,) for v in states[i]], "v bigint").coalesce(1).write.parquet(new)
        snapshots.commit(spark, path, new, i=i)

    def poll():
        while not done.is_set():
            try:
                seen.append(sorted(r.v for r in readers.parquet_folder(spark, path, "v bigint").collect()))
            except Exception as e:  # noqa: BLE001
                seen.append(repr(e))

    put(0)
    reader = threading.Thread(target=poll)
    reader.start()
    for i in range(1, 12):
        put(i)
        snapshots.vacuum(spark, path)
    done.set()
    reader.join()
    assert len(seen) > 5
    assert all(s in states for s in seen), [s for s in seen if s not in states][:1]
    assert len(list((tmp_path / "t" / "snapshots").iterdir())) == 12
    snapshots.vacuum(spark, path, 0)
    assert len(list((tmp_path / "t" / "snapshots").iterdir())) == 1


def test_a_crash_before_the_commit_leaves_the_old_state(spark, tmp_path, monkeypatch):
    path = str(tmp_path)
    K.compact(files(spark, BODIES[:1]), path)

    def crash(*_, **__):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(K.snapshots, "commit", crash)
        with pytest.raises(OSError, match="gone"):
            K.compact(files(spark, BODIES), path)
    assert {r.rec_key for r in K.committed(spark, path).collect()} == {1, 2, 3}

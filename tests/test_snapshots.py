import pytest

from burstline.schemas import BLACKLIST
from burstline.sources.blacklist import read_blacklist, store_blacklist
from burstline.sources.snapshots import Snapshots
from burstline.streaming import compaction
from burstline.streaming.compaction import compact, latest, vacuum
from burstline.streaming.pointer import Folder


def listed(spark, *users):
    return spark.createDataFrame([(u, "reason", "2024-01-01") for u in users], BLACKLIST)


def users(frame):
    return sorted(r.User_ID for r in frame.collect())


def test_a_list_is_replaced_under_its_readers(spark, tmp_path):
    path = str(tmp_path / "list")
    with pytest.raises(FileNotFoundError):
        read_blacklist(spark, path)
    assert store_blacklist(listed(spark, "a"), path) == 1
    before = read_blacklist(spark, path)
    assert store_blacklist(listed(spark, "b", "c"), path) == 2
    # A reader keeps what it resolved, a new one sees the new list, an old one can be named.
    assert users(before) == ["a"] and users(read_blacklist(spark, path)) == ["b", "c"]
    assert users(read_blacklist(spark, path, 1)) == ["a"]


def test_what_is_not_published_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "list")
    store_blacklist(listed(spark, "a"), path)

    def lost(*_):
        raise RuntimeError("lost before the pointer")

    with monkeypatch.context() as patch:
        patch.setattr(Folder, "replace", lost)
        with pytest.raises(RuntimeError):
            store_blacklist(listed(spark, "b"), path)
    snapshots = Snapshots(spark, path)
    assert snapshots.current() == 1 and snapshots.numbers() == [1, 2]
    assert users(read_blacklist(spark, path)) == ["a"]
    assert store_blacklist(listed(spark, "c"), path) == 3


def test_pins_and_expiry(spark, tmp_path):
    path, log = str(tmp_path / "list"), str(tmp_path / "pins")
    snapshots = Snapshots(spark, path)
    with pytest.raises(FileNotFoundError):
        snapshots.pinned(0, log)
    for name in "abcd":
        store_blacklist(listed(spark, name), path)
        if name in "ac":
            snapshots.pinned(ord(name), log)
    assert [snapshots.pinned(ord(n), log) for n in "acd"] == [1, 3, 4]
    assert snapshots.expire(keep=2) == [1, 2] and snapshots.numbers() == [3, 4]
    assert snapshots.expire(keep=1) == [3] and users(read_blacklist(spark, path)) == ["d"]
    with pytest.raises(ValueError):
        snapshots.expire(keep=0)


def store(spark, path, batch, rows):
    frame = spark.createDataFrame(rows, "k string, n long, x double")
    frame.write.mode("overwrite").parquet(f"{path}/batch_id={batch}")


def state(spark, path):
    return sorted(map(tuple, latest(spark, path, ["k"]).collect()))


def test_compaction_keeps_the_newest_rows(spark, tmp_path):
    path = str(tmp_path / "log")
    with pytest.raises(FileNotFoundError):
        latest(spark, path, ["k"])
    store(spark, path, 0, [("a", 1, 1.0), ("b", 1, None)])
    store(spark, path, 1, [("a", 2, 2.0)])
    assert compact(spark, path, ["k"]) == 1 and compact(spark, path, ["k"]) == 1
    assert state(spark, path) == [("a", 2, 2.0), ("b", 1, None)]
    store(spark, path, 2, [("b", 5, 5.0), ("c", 1, 1.0)])
    # A batch that is in the base and comes again is not read.
    store(spark, path, 1, [("a", 99, 9.0)])
    assert state(spark, path) == [("a", 2, 2.0), ("b", 5, 5.0), ("c", 1, 1.0)]
    assert compact(spark, path, ["k"]) == 2
    newest = state(spark, path)
    gone = vacuum(spark, path)
    assert sorted(g for g in gone if g.startswith("batch")) == [f"batch_id={n}" for n in range(3)]
    assert len([g for g in gone if g.startswith("_base/1-")]) == 1
    assert state(spark, path) == newest and vacuum(spark, path) == []


@pytest.mark.parametrize("lost_at", ["base", "manifest"])
def test_a_compaction_lost_half_way_changes_nothing(spark, tmp_path, monkeypatch, lost_at):
    path = str(tmp_path / "log")
    store(spark, path, 0, [("a", 1, 1.0)])
    compact(spark, path, ["k"])
    store(spark, path, 1, [("a", 2, 2.0), ("b", 1, 1.0)])

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(Folder, "replace", lost)
        if lost_at == "base":
            patch.setattr(compaction, "_newest", lost)
        with pytest.raises(RuntimeError):
            compact(spark, path, ["k"])
    assert state(spark, path) == [("a", 2, 2.0), ("b", 1, 1.0)]
    assert compact(spark, path, ["k"]) == 1
    assert state(spark, path) == [("a", 2, 2.0), ("b", 1, 1.0)]
    # What the lost one had written goes with the rest.
    bases = [g for g in vacuum(spark, path) if g.startswith("_base/")]
    assert len(bases) == (2 if lost_at == "manifest" else 1)


def test_a_batch_that_was_not_finished_is_not_read(spark, tmp_path):
    path = str(tmp_path / "log")
    store(spark, path, 0, [("a", 1, 1.0)])
    store(spark, path, 1, [("a", 2, 2.0)])
    Folder(spark, path).remove("batch_id=1/_SUCCESS")
    assert state(spark, path) == [("a", 1, 1.0)] and compact(spark, path, ["k"]) == 0
    store(spark, path, 1, [("a", 2, 2.0)])
    assert state(spark, path) == [("a", 2, 2.0)]

"""Registry snapshots and folder swaps, also when they are interrupted."""

from pathlib import Path

import pytest

from chatnorm.plans import dedup_file as D
from chatnorm.plans import tracking
from chatnorm.plans.generations import Generations


def statuses(spark, path):
    return {(r.domain, r.dataset_id): r.status for r in tracking.read_registry(spark, path).collect()}


def test_the_registry_reads_a_bounded_number_of_files(spark, tmp_path):
    path, expected, most = str(tmp_path / "registry"), {}, 0
    for run in range(30):
        marks = [("d", f"x{run % 7}", f"s{run}"), ("e", f"x{run}", "added"), ("d", f"x{run % 7}", f"t{run}")]
        tracking.mark(spark, path, marks, compact_after=4)
        expected |= {(d, x): s for d, x, s in marks}
        registry = tracking._Registry(spark, path)
        most = max(most, len(registry.tail))
        assert len(registry.files) <= 2 * 5 + 1
    assert statuses(spark, path) == expected
    assert most <= 5


def test_marks_that_come_while_a_snapshot_is_made_count(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "registry")
    for run in range(3):
        tracking.mark(spark, path, [("d", "a", f"s{run}")])
    real = Generations.publish

    def late(self, generation):
        tracking.mark(spark, path, [("d", "a", "late"), ("d", "b", "added")])
        real(self, generation)

    with monkeypatch.context() as patch:
        patch.setattr(Generations, "publish", late)
        tracking.compact_registry(spark, path, after=1)
    assert statuses(spark, path) == {("d", "a"): "late", ("d", "b"): "added"}


def test_a_snapshot_that_was_not_finished_is_not_read(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "registry")
    for run in range(3):
        tracking.mark(spark, path, [("d", "a", f"s{run}")])

    def stop(self, generation):
        raise OSError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(Generations, "publish", stop)
        with pytest.raises(OSError):
            tracking.compact_registry(spark, path, after=1)
    assert statuses(spark, path) == {("d", "a"): "s2"}
    tracking.compact_registry(spark, path, after=1)
    assert statuses(spark, path) == {("d", "a"): "s2"}
    assert tracking._Registry(spark, path).tail == []


class Stop(Exception):
    pass


@pytest.mark.parametrize("steps", range(5))
def test_a_swap_that_stopped_is_ended_by_the_next_call(spark, tmp_path, monkeypatch, steps):
    path = str(tmp_path / "t.parquet")
    spark.createDataFrame([(1,), (1,), (2,)], "k int").write.parquet(path)
    done = []
    real = D.file_system

    class Watched:
        """A file system that stops before its change number ``steps``."""

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            call = getattr(self.fs, name)
            if name not in ("rename", "delete", "create"):
                return call

            def counted(*args):
                if len(done) == steps:
                    raise Stop
                done.append(name)
                return call(*args)

            return counted

    def watched(session, where):
        fs, place = real(session, where)
        return Watched(fs), place

    with monkeypatch.context() as patch:
        patch.setattr(D, "file_system", watched)
        with pytest.raises(Stop):
            D.dedup_file(spark, path, subset=["k"], inplace=True)
    D._Swap(spark, path).finish()
    # Nothing had been promised before the journal was written: the table is the old one.
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == ([1, 1, 2] if steps == 0 else [1, 2])
    D.dedup_file(spark, path, subset=["k"], inplace=True)
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 2]
    assert sorted(p.name for p in Path(tmp_path).iterdir() if not p.name.startswith(".")) == ["t.parquet"]

import os

import pytest

from starloom import session as se


class _NoFolder:
    """A session that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        @staticmethod
        def getCheckpointDir():
            return None


def test_a_shared_folder_is_required():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        se.scratch_root(_NoFolder)


def test_scratch_lies_below_the_application_and_can_be_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(se, "scratch_folder", lambda s: str(tmp_path / "starloom" / "app"))
    out = se.materialise(spark.range(5), "five")
    assert out.count() == 5 and os.listdir(tmp_path / "starloom" / "app")
    assert se.remove_scratch(spark) and not (tmp_path / "starloom" / "app").exists()
    assert not se.remove_scratch(spark)


def test_side_by_side_raises_the_first_failure(spark):
    assert se.side_by_side([lambda: 1, lambda: 2]) == [1, 2]
    with pytest.raises(ZeroDivisionError):
        se.side_by_side([lambda: 1, lambda: 1 // 0])

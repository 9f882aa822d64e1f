"""The shared folder and the tables in it."""

from __future__ import annotations

import os

from waymark import session
from waymark.session import drop_intermediate, new_path, run_folder, saved, shared_folder


def test_intermediate_tables_are_dropped_together(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(tmp_path))
    other = tmp_path / "another-run"
    other.mkdir()
    first, second = saved(spark.range(5), "a"), saved(spark.range(7), "a", "zstd")
    assert (first.count(), second.count()) == (5, 7)
    assert len(os.listdir(run_folder(spark))) == 2 and new_path(spark, "a") != new_path(spark, "a")
    drop_intermediate(spark)
    assert os.listdir(tmp_path) == ["another-run"]
    # With nothing to drop nothing happens.
    drop_intermediate(spark)


def test_the_shared_folder_is_the_named_one(spark):
    assert run_folder(spark).startswith(shared_folder(spark)) and shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

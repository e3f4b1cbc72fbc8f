"""Landed tables are cleared by age."""

import os
import time

from firstmile.llm import store


def test_old_tables_go(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "shared_folder", lambda spark: str(tmp_path))
    assert store.clear(spark) == 0
    old, new = (store.land(spark.range(n), "t") for n in (3, 4))
    folder = old.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
    os.utime(folder, (time.time() - 7200,) * 2)
    assert store.clear(spark) == 0 and store.clear(spark, hours=1) == 1
    assert not os.path.exists(folder) and new.count() == 4
    assert store.clear(spark, hours=0) == 1 and not [x for x in os.listdir(tmp_path / "llm") if not x.endswith(".crc")]

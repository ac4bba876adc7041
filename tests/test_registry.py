"""Stored tables live as long as their input stays the same, and no longer than the session."""

import os
import shutil

import pyarrow.parquet as pq
import pytest
from conftest import SF

from touchline.plans import registry


@pytest.fixture
def folder(tmp_path):
    for name in registry.INPUT_TABLES:
        shutil.copy(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
        os.chmod(tmp_path / f"{name}.parquet", 0o644)
    return tmp_path


def test_changed_input_gives_new_answers(spark, folder):
    first = registry.Inputs(spark, str(folder))
    n = first.stored.count()
    assert registry.Inputs(spark, str(folder)).stored.inputFiles() == first.stored.inputFiles()
    old = [p for k, p in registry._WRITTEN.items() if k[1] == str(folder)]
    fits = []
    for _ in range(2):
        registry.fitted(first, "probe", lambda: fits.append(1))
    orders = pq.read_table(folder / "orders.parquet")
    pq.write_table(orders.slice(0, n // 2), folder / "orders.parquet")
    second = registry.Inputs(spark, str(folder))
    assert second.stored.count() == n // 2
    registry.fitted(second, "probe", lambda: fits.append(2))
    assert fits == [1, 2]
    assert not any(os.path.exists(p.removeprefix("file:")) for p in old)


def test_nothing_is_left(spark, folder):
    registry.Inputs(spark, str(folder)).stored.count()
    kept = {k: p for k, p in registry._WRITTEN.items()}
    mine = [p for k, p in kept.items() if k[1] == str(folder)]
    others = {k: registry._WRITTEN.pop(k) for k in kept if k[1] != str(folder)}  # the other tests go on using theirs
    models = dict(registry._FITTED)
    registry.forget(spark)
    registry._WRITTEN.update(others)
    registry._FITTED.update(models)
    assert mine and not any(os.path.exists(p.removeprefix("file:")) for p in mine)

"""Landing: only what is asked for, one published folder, sizes, and no local
scratch folder on a cluster."""

import os

import pytest

from hazeline import session
from hazeline.sources import fs, landing

SF0001 = "/root/testdata/sf0.001"


def test_only_the_asked_layer_is_landed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "scratch_path", lambda s, *parts: os.path.join(str(tmp_path), *parts))
    assert landing.bronze(spark, SF0001).count() > 0
    names = [f for _, folders, _ in os.walk(tmp_path) for f in folders]
    assert any(f.startswith("bronze-") for f in names) and not any(f.startswith(("silver", "gold")) for f in names)
    assert landing.land_bronze(spark, SF0001) == landing.land_bronze(spark, SF0001)


def test_the_first_published_folder_stays(spark, tmp_path):
    marker = f"file://{tmp_path}/x.at"
    fs.publish(spark, marker, "one")
    fs.publish(spark, marker, "two")
    assert fs.read_marker(spark, marker) == "one"
    fs.publish(spark, marker, "three", replace=True)
    assert fs.read_marker(spark, marker) == "three" and fs.read_marker(spark, marker + "-none") is None


def test_files_by_size_and_partition():
    assert landing.salts_for(0, 0) == 1 and landing.salts_for(5 << 30, 10) == 1
    assert landing.salts_for(100 << 40, 10) == 10_240


class _Conf:
    def __init__(self, master):
        self.master = master

    def get(self, key, default=None):
        return self.master if key == "spark.master" else default


class _Session:
    def __init__(self, master):
        self.conf = _Conf(master)
        self.sparkContext = type("C", (), {"getCheckpointDir": staticmethod(lambda: None)})()


@pytest.mark.parametrize("master", ["yarn", "spark://host:1", "local-cluster[2,1,1024]"])
def test_no_local_scratch_on_a_cluster(master):
    with pytest.raises(RuntimeError):
        session.scratch_dir(_Session(master))

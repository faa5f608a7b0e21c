from types import SimpleNamespace

import pytest

from orderlake.session import TUNING, shared_dir, tune


def fake(conf, master):
    context = SimpleNamespace(master=master, applicationId="app-test", getCheckpointDir=lambda: None)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)), sparkContext=context)


def test_shared_folder_is_the_one_the_cluster_names():
    session = fake({"spark.checkpoint.dir": "hdfs://nn/check/"}, "yarn")
    one, two = shared_dir(session, "updates"), shared_dir(session, "updates")
    assert one.startswith("hdfs://nn/check/orderlake/updates-") and one != two


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake({}, "yarn"), "updates")


def test_executors_of_their_own_need_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(fake({}, "local-cluster[2,1,1024]"), "updates")


def test_a_local_session_may_use_its_own_folder():
    assert "/orderlake/updates-" in shared_dir(fake({}, "local[8]"), "updates")


def test_tuning_is_applied(spark):
    tune(spark)
    assert all(spark.conf.get(key) == value for key, value in TUNING.items())


def test_a_lake_is_made_anew_when_its_files_change(spark, tmp_path):
    import shutil

    from orderlake import registry

    shutil.copytree("/root/testdata/sf0.001", tmp_path / "sf")
    path = str(tmp_path / "sf")
    first = registry.lake_of(spark, path)
    cities = registry.QUERIES["dq_report"](spark, path).where("check_name = 'unique fct_orders.order_id'").collect()
    assert registry.lake_of(spark, path) is first and cities[0].status == "pass"
    n = first.raw_orders.count()
    orders = spark.read.parquet(f"{path}/orders.parquet")
    orders.limit(100).coalesce(1).write.parquet(f"{path}/fewer")
    (tmp_path / "sf" / "orders.parquet").unlink()
    (tmp_path / "sf" / "fewer").rename(tmp_path / "sf" / "orders.parquet")
    assert registry.lake_of(spark, path) is not first and registry.lake_of(spark, path).raw_orders.count() < n
    registry.forget()
    assert registry.lake_of(spark, path).raw_orders.count() < n

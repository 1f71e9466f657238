from framewise import settings


def test_shared_folder_is_the_sessions(spark, monkeypatch):
    assert settings.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_run_dirs_are_cleared_on_demand(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(settings, "_made", [])
    monkeypatch.setattr(settings, "shared_dir", lambda _: str(tmp_path))
    table = settings.write_through(spark.range(3), "three")
    assert table.count() == 3 and len(list(tmp_path.iterdir())) == 1
    settings.run_dir(spark, "never-written")
    settings.clear_run_dirs(spark)
    assert list(tmp_path.iterdir()) == [] and settings._made == []

import os

from docmill import session


def test_written_tables_of_a_job_are_deleted(spark):
    scratch = session.Scratch()
    first = scratch.written(spark.range(10), "numbers")
    second = session.written(first.where("id > 4"), "some")
    folder = os.path.join(session.shared_dir(spark), "docmill")
    made = [f for f in os.listdir(folder) if f.startswith("numbers-")]
    assert made and first.count() == 10
    scratch.clear()
    assert not [f for f in os.listdir(folder) if f.startswith("numbers-")]
    assert second.count() == 5
    scratch.clear()


def test_the_package_is_shipped_once(spark, monkeypatch):
    added = []
    monkeypatch.setattr(type(spark.sparkContext), "addPyFile", lambda self, path: added.append(path))
    monkeypatch.setattr(session, "_shipped_to", {})
    session.ship(spark)
    session.ship(spark)
    assert len(added) == 1 and added[0].endswith("docmill.zip")

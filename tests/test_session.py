"""Where staged tables go."""

import os
import types

import pytest

from voltaria import session


def test_a_cluster_must_name_its_folder(spark, monkeypatch):
    context = types.SimpleNamespace(master="spark://host:7077", applicationId="x", _jsc=types.SimpleNamespace(sc=lambda: types.SimpleNamespace(getCheckpointDir=lambda: types.SimpleNamespace(isDefined=lambda: False))))
    other = types.SimpleNamespace(conf=types.SimpleNamespace(get=lambda key, default: default), sparkContext=context)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(other)


def test_staged_tables_share_one_folder_that_goes_with_the_session(spark):
    held = spark.sparkContext._jsc.sc().getCheckpointDir().isDefined()
    made = session.stage(spark.range(5), "numbers")
    assert made.count() == 5
    folder = session.session_dir(spark)
    assert all(f.startswith(f"file://{folder}/") or f.startswith(f"file:{folder}/") for f in made.inputFiles())
    assert spark.sparkContext.applicationId in folder and os.path.isdir(folder)
    assert spark.sparkContext._jsc.sc().getCheckpointDir().isDefined() == held

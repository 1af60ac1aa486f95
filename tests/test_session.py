import os

import pytest

from kestrel import session
from kestrel.functions.text import french_phone


def test_materialized_tables_of_a_block_are_removed(spark):
    with session.scratch(spark):
        df = session.materialize(spark.range(5), "t")
        path = df.inputFiles()[0].removeprefix("file://").rpartition("/")[0]
        assert df.count() == 5 and os.path.isdir(path)
    assert not os.path.exists(path)


def test_shared_folder_is_required_on_a_cluster(monkeypatch):
    assert session.is_single_process("local") and session.is_single_process("local[8]")
    assert not session.is_single_process("local-cluster[2,1,1024]") and not session.is_single_process("yarn")

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_phone_prefixes(spark):
    df = spark.createDataFrame([("0033 6 12 34 56 78",), ("+33 6 12 34 56 78",), ("06 12 34 56 78",)], "n string")
    assert {r.p for r in df.select(french_phone("n").alias("p")).collect()} == {"+33612345678"}

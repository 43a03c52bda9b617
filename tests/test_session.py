import os
import subprocess
import sys

from siltstone.session import instant, scratch_path, shared_folder

_NAMED = """
import sys
from siltstone.session import local_session, cut_lineage, scratch_path, shared_folder
spark = local_session(1, **{"spark.checkpoint.dir": sys.argv[1]})
assert shared_folder(spark) == sys.argv[1]
assert scratch_path(spark, "x").startswith(sys.argv[1] + "/x-")
assert cut_lineage(spark.range(3)).count() == 3
"""


def test_named_checkpoint_folder_is_used(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run(
        [sys.executable, "-c", _NAMED, str(tmp_path)], check=True, cwd=root, timeout=300
    )
    assert any(tmp_path.iterdir())


def test_unset_folder_is_chosen_once(spark):
    assert shared_folder(spark) == shared_folder(spark)
    assert scratch_path(spark, "a") != scratch_path(spark, "a")


def test_instants(spark):
    from datetime import datetime

    row = spark.range(1).select(
        instant("2024-06-01T02:00:00+02:00").cast("string").alias("a"),
        instant(datetime(2024, 6, 1)).cast("string").alias("b"),
        instant().isNotNull().alias("c"),
    ).first()
    assert tuple(row) == ("2024-06-01 00:00:00", "2024-06-01 00:00:00", True)

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "examples"))

from conftest import SF_SMALL  # noqa: E402


def test_exercise_walkthrough_runs(spark, capsys):
    import exercises
    exercises.main(SF_SMALL)
    out = capsys.readouterr().out
    assert "== forest search" in out and "best test RMSE" in out

"""What the plans of the window layer look like: one shuffle by the clip, no product of tables."""

from pathlib import Path

import pytest

from tidemark.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.is_dir(), reason="no driver tables")
WINDOWS = ("w01_w02_hand_decimation", "w03_covered_windows", "w04_idle_runs", "w05_longest_run", "w06_first_differences", "f10_f11_p04_hand_evidence", "f10_p05_p06_camera_evidence", "w11_sample_chunks")


def plan(spark, name):
    return QUERIES[name](spark, str(DATA))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", WINDOWS)
def test_one_shuffle_by_the_clip(spark, name):
    text = plan(spark, name).split("== Initial Plan ==")[-1]
    exchanges = [x for x in text.split("\n") if "Exchange" in x]
    assert len(exchanges) == 1 and all("hashpartitioning(user_id" in x for x in exchanges)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products(spark, name):
    text = plan(spark, name)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ("v02_a21_a22_a23_a24_f03_frame_quality", "a25_j12_u06_region_activity", "p15_j14_v06_decoded_boxes", "s04_probed_clips"))
def test_frames_stay_in_their_row(spark, name):
    text = plan(spark, name)
    assert "Exchange" not in text and "Python" not in text and "Arrow" not in text


@pytest.mark.parametrize("name", ("s04_iso_index", "v05_detector_input"))
def test_files_and_frames_are_spread_before_they_are_drawn(spark, name):
    """rows of a small file, far more work than bytes, aren't left to as many tasks as the file has pieces."""
    text = plan(spark, name)
    assert "REPARTITION_BY_NUM" in text and text.index("ArrowEvalPython") < text.index("REPARTITION_BY_NUM")


def test_evidence_is_drawn_after_it_is_picked(spark):
    """frames aren't shuffled to the join, and rendering is spread."""
    text = plan(spark, "v09_rendered_evidence").split("== Initial Plan ==")[-1]
    assert "REPARTITION_BY_NUM" in text and text.index("unhex") < text.index("REPARTITION_BY_NUM") < text.index("Join")


def test_evidence_is_rendered_once(spark):
    """a filter on images was pushed below their step, which then ran twice."""
    assert plan(spark, "v09_rendered_evidence").count("ArrowEvalPython") == 1

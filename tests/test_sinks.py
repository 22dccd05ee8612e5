"""Written intermediates and the training frame."""

import os
import tempfile

from pyspark.sql import functions as F

from tutorlens.operators import encode, features
from tutorlens.plans import flows
from tutorlens.sources.fixtures import fixture_tables

def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_shrink_clicks_roundtrip(spark, sf001):
    vle = fixture_tables(spark, sf001)["student_vle"]
    out = os.path.join(tempfile.mkdtemp(prefix="tutorlens-small-"), "studentVle_small")
    back = flows.shrink_clicks(vle, out, fmt="csv")
    assert _rows(back) == _rows(features.clicks_per_student(vle))


def test_training_frame(spark, sf001):
    t = fixture_tables(spark, sf001)
    master = flows.whole_course_master(t)
    frame = flows.training_splits(master, flows.DROP_WHOLE)
    assert frame.count() == master.count()
    views = encode.split_views(frame)
    assert sum(v.count() for v in views.values()) == master.count()
    # every one-hot group has exactly one true flag per row (fixture has no missing category)
    for c in encode.CATEGORY_COLUMNS:
        flags = [x for x in frame.columns if x.startswith(c + "_")]
        total = sum(F.col(f"`{x}`").cast("int") for x in flags)
        assert frame.where(total != 1).count() == 0

"""Folders of plans written to the shared folder."""

import pytest

from reelhouse.session import children, scratch, shared_folder, written


def test_scratch_removes_what_was_written_in_it(spark):
    names = lambda: {n for n in children(spark, shared_folder(spark, "")) if n.startswith("of-")}
    before = names()
    with scratch(spark):
        with scratch(spark):
            written(spark.range(3), "of-inner")
            kept = written(spark.range(5), "of-outer", keep=True)
        assert len(names() - before) == 1 and kept.count() == 5
    assert names() == before
    with scratch(spark):
        kept = written(spark.range(7), "of-all", keep=True)
    assert kept.count() == 7
    with pytest.raises(ZeroDivisionError), scratch(spark):
        written(spark.range(2), "of-failed")
        raise ZeroDivisionError
    assert len(names() - before) == 1

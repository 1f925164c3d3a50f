import os

from tidelog.storage import create_text, read_text, scratch, scratch_folder, shared_dir, write_text


def test_scratch_folders_go_at_the_end(spark):
    outside = scratch(spark, "kept")
    write_text(spark, outside, "x")
    with scratch_folder(spark, "step"):
        first = scratch(spark, "a")
        write_text(spark, first, "x")
        with scratch_folder(spark, "inner"):
            second = scratch(spark, "b")
            write_text(spark, second, "x")
        assert not os.path.exists(second) and os.path.exists(first)
    assert not os.path.exists(first) and os.path.exists(outside)
    assert os.path.dirname(scratch(spark, "c")) == shared_dir(spark)


def test_a_folder_without_files_goes_too(spark):
    with scratch_folder(spark, "empty"):
        pass


def test_only_one_creates_a_text(spark, path):
    assert create_text(spark, path("claim"), "é 1")
    assert not create_text(spark, path("claim"), "2")
    assert read_text(spark, path("claim")) == "é 1"

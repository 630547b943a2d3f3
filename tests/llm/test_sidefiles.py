"""Facts are only handed to the rows they were made for."""

import pyarrow as pa
import pytest

from tickloom.llm import sidefiles


def facts(rows, ids):
    return pa.table({"row": pa.array(rows, pa.int64()), "doc_id": pa.array(ids, pa.int64())})


def test_facts_meet_their_rows():
    ids = pa.array([7, None, 9, 9], pa.int64())
    sidefiles.same_rows(facts([10, 11, 13, 13], [7, None, 9, 9]), 10, ids)
    sidefiles.same_rows(facts([11], [3]), 11, pa.array([3], pa.int32()))
    for rows, known in (([10], [8]), ([11], [7]), ([10], [None]), ([10, 11], [None, 7])):
        with pytest.raises(RuntimeError):
            sidefiles.same_rows(facts(rows, known), 10, ids)


def test_a_side_folder_gives_each_partition_its_rows(spark):
    given = spark.createDataFrame([(0, 5, 50), (1, 2, 20), (0, 3, 30)], "part int, row long, doc_id long")
    folder = sidefiles.write_side(given, "test-side")
    reader = sidefiles.SideReader(folder, 0)
    assert reader.of(0, 10).column("doc_id").to_pylist() == [30, 50]
    assert reader.of(4, 1) is None and reader.of(5, 1).column("row").to_pylist() == [5]
    assert sidefiles.SideReader(folder, 9).of(0, 10) is None

"""Feature tables are published whole, or not at all."""

import pytest

from weft.sources.sinks import feature_table_meta, read_table, write_feature_table
from weft.sources.tables import path_exists, path_stamp


def test_a_bad_key_leaves_the_old_table(spark, tmp_path):
    path = f"{tmp_path}/deep/features"
    write_feature_table(spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string"), path, "k", "first")
    for rows in ([(1, "x"), (1, "y")], [(None, "x")]):
        with pytest.raises(ValueError):
            write_feature_table(spark.createDataFrame(rows, "k long, v string"), path, "k")
        assert sorted(map(tuple, read_table(spark, path).collect())) == [(1, "a"), (2, "b")]
    assert feature_table_meta(spark, path)["description"] == "first"
    before = path_stamp(spark, path)
    write_feature_table(read_table(spark, path).selectExpr("k + 1 AS k", "v"), path, "k")  # from its own rows
    assert sorted(map(tuple, read_table(spark, path).collect())) == [(2, "a"), (3, "b")]
    assert path_stamp(spark, path) != before and path_exists(spark, path) and not path_exists(spark, f"{path}.none")

import pytest

from upcheck.sources.jdbc import jdbc_options


def test_jdbc_options_basic():
    o = jdbc_options("jdbc:postgresql://h/db", "public.t", user="u", password="p")
    assert o["url"] == "jdbc:postgresql://h/db" and o["dbtable"] == "public.t"
    assert o["user"] == "u" and "partitionColumn" not in o


def test_jdbc_options_partitioned():
    o = jdbc_options("u", "t", partition_column="id", lower_bound=0, upper_bound=100, num_partitions=8)
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("id", "0", "100", "8")
    with pytest.raises(ValueError):
        jdbc_options("u", "t", partition_column="id")

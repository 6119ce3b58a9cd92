"""JDBC helpers: argument checks only.

A roundtrip needs a database, and no database may be started here (not even an
embedded one), so the read and append against a live URL are left untested.
"""

import pytest

from lakelayer.sinks.jdbc import read_jdbc


def test_read_needs_exactly_one_source(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none:", query="select 1", table="t")
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none:")


def test_partitioned_read_needs_bounds(spark):
    with pytest.raises(ValueError):
        read_jdbc(spark, "jdbc:none:", table="t", partition_column="id")

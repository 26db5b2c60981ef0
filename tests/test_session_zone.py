"""Time results do not depend on the session time zone of the caller."""

import pytest

import __spark_entry__ as entry
from tests.compare import assert_same
from tests.conftest import SF_SMALL

TIME_QUERIES = ["fn_unix_to_text", "fn_review_year", "fn_year_to_date", "monthly_volume", "daily_volume_gaps",
                "monthly_volume_from_year", "yearly_review_count", "category_year_pivot"]


@pytest.mark.parametrize("name", TIME_QUERIES)
def test_zone_independent(spark, duck, name):
    con = duck(SF_SMALL)
    want = con.sql(entry.oracle_sql()[name]).df()
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("America/New_York", "Asia/Kolkata"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            got = entry.queries()[name](spark, SF_SMALL).toPandas()
            assert_same(got, want, f"{name}@{zone}")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)

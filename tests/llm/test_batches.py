"""Arrow batches of whole texts are small."""

from lakestrata.llm.common import BATCH_ROWS, small_batches

NUMBER = "spark.sql.execution.arrow.maxRecordsPerBatch"


def test_a_session_without_a_number_gets_small_batches(spark):
    plain, given = spark.newSession(), spark.newSession()
    given.conf.set(NUMBER, 77)
    small_batches(plain)
    small_batches(given)
    assert plain.conf.get(NUMBER) == str(BATCH_ROWS)
    assert given.conf.get(NUMBER) == "77"

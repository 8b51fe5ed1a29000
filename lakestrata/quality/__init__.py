from lakestrata.quality.expectations import (
    Expectation,
    expect_length_equal,
    expect_match_regex,
    expect_type,
    expect_unique_key,
)
from lakestrata.quality.suite import (
    DataQualityError,
    SuiteWatch,
    key_violations,
    read_dq_report,
    run_suite,
    suite_name,
    watch_suite,
    write_dq_report,
)
from lakestrata.quality.values import unexpected_values

__all__ = [
    "DataQualityError",
    "Expectation",
    "SuiteWatch",
    "expect_length_equal",
    "expect_match_regex",
    "expect_type",
    "expect_unique_key",
    "key_violations",
    "read_dq_report",
    "run_suite",
    "suite_name",
    "unexpected_values",
    "watch_suite",
    "write_dq_report",
]

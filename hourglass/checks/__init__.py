"""Oracle SQL fragments and result comparison helpers used by the query
registry and the tests."""

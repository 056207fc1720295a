"""All registered queries and their reference SQL."""

from riskweave.plans import suite_feeds, suite_jobs, suite_model, suite_policy, suite_tables, suite_text

SUITES = (suite_policy, suite_model, suite_tables, suite_text, suite_feeds, suite_jobs)
QUERIES = {name: fn for s in SUITES for name, fn in s.QUERIES.items()}


def oracles():
    return {name: sql for s in SUITES for name, sql in s.oracles().items()}

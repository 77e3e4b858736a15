"""cohortlens: training-platform analytics as Spark DataFrame plans.

Snapshots of users, courses, cohorts, enrolments, grades, completions and
attendance are turned into a small star schema (``operators.model``) and the
business reports built on it (``operators.reports`` and friends). Every
operator is a function ``DataFrame(s) -> DataFrame``; nothing iterates rows on
the driver.
"""

from cohortlens.functions.rules import Rules

__all__ = ["Rules"]

"""Sources: the five job inputs (S1-S5) and the fixture views that derive them
from the given test tables."""

from buyerlens.sources.fixtures import FIXTURE_SQL, fixture_inputs, fixture_sql_for_duckdb
from buyerlens.sources.tables import Inputs, scan_inputs

__all__ = ["FIXTURE_SQL", "Inputs", "fixture_inputs", "fixture_sql_for_duckdb", "scan_inputs"]

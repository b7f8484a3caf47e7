"""tablewright: table preparation and data-quality checks on Spark DataFrames.

Every public function takes and returns DataFrames (or Column expressions),
so steps compose with ``df.transform(...)`` and Catalyst optimises the
whole chain as one plan.
"""

from tablewright.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]

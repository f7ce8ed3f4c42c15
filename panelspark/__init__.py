"""panelspark: analysis jobs over entity-day panel data, built on Spark DataFrames.

A panel is a table keyed by (entity, date) whose entities belong to a group.
The package offers:

* ``sources``   - readers for the base tables and the two derived panels
* ``functions`` - Column helpers (safe percentages, banding, growth)
* ``operators`` - reusable DataFrame operators (latest rows, rolling stats,
                  crossings, two-level profiles, panel joins, global ranks)
* ``plans``     - the twenty analysis jobs, one DataFrame function each
* ``oracle``    - equivalent DuckDB SQL used as the correctness oracle
"""

from panelspark.spec import PanelSpec

__all__ = ["PanelSpec"]
__version__ = "0.1.0"

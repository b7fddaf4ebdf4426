"""Registry of named queries: ``QUERIES[name](spark, sf_dir) -> DataFrame`` and
the matching DuckDB text ``ORACLE[name]``. Both sides alias every computed
column to the same name and round doubles to 6 digits.

Queries live in one module per stage; importing them registers them (in
dependency order: later stages reuse the SQL steps of earlier ones).
"""

from tarmac.plans import queries_features  # noqa: F401  (first: others reuse its steps)
from tarmac.plans import queries_eda  # noqa: F401
from tarmac.plans import queries_baselines  # noqa: F401
from tarmac.plans import queries_prep  # noqa: F401
from tarmac.plans import queries_models  # noqa: F401
from tarmac.plans import queries_months  # noqa: F401
from tarmac.plans import queries_sources  # noqa: F401
from tarmac.plans.core import ORACLE, QUERIES, Ctx  # noqa: F401
from tarmac.plans.queries_baselines import _m1_parts, _ravg90, _split, _study  # noqa: F401

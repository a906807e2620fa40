"""All registered query keys and their oracle SQL."""

from __future__ import annotations

from orchard.plans.q_bayes import BAYES_QUERIES as _Q_BAYES
from orchard.plans.q_linear_tune import LINEAR_QUERIES as _Q_LINEAR
from orchard.plans.q_prep import PREP_QUERIES as _Q_PREP
from orchard.plans.q_trees_als import TREE_ALS_QUERIES as _Q_TREES
from orchard.plans.sql_bayes import BAYES_SQL as _S_BAYES
from orchard.plans.sql_core import CORE_SQL as _S_CORE
from orchard.plans.sql_linear_tune import LINEAR_SQL as _S_LINEAR

QUERIES = {**_Q_BAYES, **_Q_PREP, **_Q_LINEAR, **_Q_TREES}
ORACLE = {**_S_BAYES, **_S_CORE, **_S_LINEAR}

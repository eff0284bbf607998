"""Link-graph analytics on Spark: parse a dump, build its graph, rank its pages."""

from linkrank.operators import *  # noqa: F403
from linkrank.operators import __all__ as _operators
from linkrank.plans import *  # noqa: F403
from linkrank.plans import __all__ as _plans
from linkrank.sources import *  # noqa: F403
from linkrank.sources import __all__ as _sources

__all__ = [*_operators, *_plans, *_sources]

"""Registration of every job over the driver tables, with its SQL oracle.

Importing a ``*_jobs`` module registers its jobs; the import order below is
the order of ``queries()``.
"""

from __future__ import annotations

from . import tpch
from .registry import register

register("g13_tpch_q3", tpch.g13, tpch.G13_SQL)
register("g14_tpch_q10", tpch.g14, tpch.G14_SQL)

from . import text_jobs  # noqa: F401,E402
from . import relational_jobs  # noqa: F401,E402
from . import window_jobs  # noqa: F401,E402
from . import time_jobs  # noqa: F401,E402
from . import function_jobs  # noqa: F401,E402
from . import iter_jobs  # noqa: F401,E402
from . import state_jobs  # noqa: F401,E402
from . import misc_jobs  # noqa: F401,E402
from . import trigger_jobs  # noqa: F401,E402
from . import parse_jobs  # noqa: F401,E402

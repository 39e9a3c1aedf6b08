"""spendcast: next-month purchase propensity as lazy Spark DataFrame plans.

Every public operator is a plain ``DataFrame -> DataFrame`` function over the
``transactions`` schema (see ``spendcast.sources.transactions``).  Nothing in the
library collects data-sized results to the driver; the few eager steps are
reliable checkpoints (``spendcast.operators.scan``) and Spark ML fits.
"""

from spendcast.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]

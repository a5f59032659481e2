"""Column -> Column building blocks (all JVM-side built-ins, no UDFs)."""

from propensia.functions.expr import *  # noqa: F401,F403
from propensia.functions.tokenize import stable_customer_token  # noqa: F401

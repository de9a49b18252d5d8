"""sparkloom: table, text and image analytics as lazy Spark DataFrame jobs.

Every public function takes and returns DataFrames (or a small ``Dataset``
wrapper that carries a name and metadata).  Nothing in the library collects
data rows to the driver; the caller owns the session and the actions.
"""

from sparkloom.errors import ValidationError
from sparkloom.dataset import Dataset

__all__ = ["ValidationError", "Dataset"]
__version__ = "0.1.0"

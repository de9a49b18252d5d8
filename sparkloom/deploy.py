"""Make the package importable in Spark's Python workers.

Arrow UDFs defined at module level are pickled by reference, so every
worker must be able to import ``sparkloom``.  ``ship_package`` zips the
package on the driver and registers it with ``SparkContext.addPyFile`` (what
``--py-files`` does): Spark serves the archive to every executor and puts
it on the workers' import path.  Done once per SparkContext.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    # the archive only needs to exist on the driver until Spark has copied it
    out_dir = tempfile.mkdtemp(prefix="sparkloom-pyfiles-")
    path = os.path.join(out_dir, "sparkloom.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(pkg_dir):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)

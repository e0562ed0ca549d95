"""barcodeforge: Spark DataFrame operators for building a DNA-barcode reference database.

Every public operator is a function ``DataFrame -> DataFrame`` (use it with
``df.transform``) or a builder returning a DataFrame; nothing is collected to
the driver except small, size-checked metadata (primer tables).
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

from barcodeforge.session import ensure_checkpoint_dir, get_spark

# Arrow stages (mapInPandas / pandas_udf) call helpers of this package. Pickling the package
# by value lets every executor run them without the package being installed or shipped.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

__all__ = ["get_spark", "ensure_checkpoint_dir"]
__version__ = "0.1.0"

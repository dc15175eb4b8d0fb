"""Candle (OHLCV) and time-series table operators for PySpark.

Every operator takes and returns a DataFrame. Series are keyed (usually by
``symbol``); order inside a series is always stated by columns, never implied
by row position.
"""

import sys

from pyspark import cloudpickle

from candlemill.session import get_session, stage

__all__ = ["get_session", "stage"]

# Functions that run in tasks travel with their code, so that executors need
# not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

"""Yearly-panel harmonisation on PySpark.

Sheets or yearly tables whose layout changes over time are mapped to one set of
metrics, united into a typed history, audited, turned into a fact with versioned
dimensions, checked and published as a whole.  Every operator takes and returns a
``DataFrame``; only schemas, the metric catalogue and check counts reach the driver.
"""

from panelloom.contract import Contract, Dimension, SCHOOL_RATES

__all__ = ["Contract", "Dimension", "SCHOOL_RATES"]

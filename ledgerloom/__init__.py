"""ledgerloom: a finance lakehouse built as plain Spark DataFrame functions.

Layers (each a ``DataFrame -> DataFrame`` function, no actions inside):

* ``sources``   raw readers, sinks and the fixture views used for testing
* ``functions`` reusable ``Column`` builders (dates, accounts, money, keys)
* ``operators`` reusable multi-step operators (amortiser, leg exploder,
  cumulative snapshots, metric views, drill-across, running draw-down)
* ``plans``     the named data products, statements, checks and queries
* ``streaming`` idempotent month-partition refresh of materialised tables
"""

__version__ = "0.1.0"

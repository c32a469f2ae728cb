"""tidemark: market-narrative stress analytics as Spark DataFrame operators.

Layers (each a plain ``DataFrame -> DataFrame`` function):

* ``sources``    -- table readers, the views over the driver tables, page extraction, snapshots
* ``functions``  -- column-expression builders (text, sentiment, keywords, dates, numbers)
* ``operators``  -- relational operators (validation, cleaning, ordering, temporal, composite,
                    quotes, risk, correlation, views)
* ``models``     -- MLlib-backed estimators and the Arrow-batched custom ones
* ``plans``      -- end-to-end compositions and the registered queries
* ``streaming``  -- incremental snapshot ingestion
"""

__version__ = "0.1.0"

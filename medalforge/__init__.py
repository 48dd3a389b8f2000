"""medalforge: a star-schema sales-analytics library on Spark DataFrames.

Layers follow the bronze / silver / gold (medallion) flow:

* ``sources``   – landing raw files (bronze), reading and writing layer tables,
                  and the test-table → silver mapping used by checks and bench.
* ``operators`` – cleansing (typing, placeholder filling, latest-row dedup),
                  surrogate keys, dimension/fact builders, size-checked joins,
                  integrity and profile checks.
* ``functions`` – column-level helpers (boundary date differences, null-safe
                  name concatenation, percentage text, CASE bands).
* ``plans``     – the named analytic queries and the two 360° reports.
* ``streaming`` – incremental landing of raw files into bronze.
"""

__version__ = "0.1.0"

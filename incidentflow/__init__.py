"""incidentflow: incident analytics expressed as Spark DataFrame plans.

Sub-packages
------------
sources     reading and writing zone tables (CSV, parquet, JDBC, catalogues)
operators   cleaning rules, profiling, enrichment joins, nearest match, splits
functions   column-level helpers (labels, flags, dictionary mappings)
ml          pyspark.ml estimators, metrics, boosted trees and contributions
plans       stand-in inputs built from the driver tables and the query catalogue
streaming   the row-wise rules running on a ``readStream`` DataFrame
"""

__version__ = "0.1.0"

"""quartermaster - table-level data-preparation operators on Spark.

Sub-packages:
  sources    readers for landed documents, relational tables, parameter tables
  functions  column expressions: scalars, labels, effect rules, report windows
  operators  table operators: merge, deletes, activity, index, nested, lookup,
             routing, snapshots, joins
  plans      compositions of operators into the jobs of the catalogue and the
             checks the driver runs against SQL
  streaming  incremental (micro-batch) driving of the batch operators
"""

__version__ = "0.1.0"

"""connlens: analytics over labelled connection records, written on Spark DataFrames.

Every public function takes DataFrames (or a SparkSession) and returns DataFrames. Column names
are arguments, so the operators also run on any other table with the same column roles.
"""

__version__ = "0.1.0"

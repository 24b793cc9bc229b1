"""Contest results by place, on Spark DataFrames.

Every operator is a function from DataFrames to a DataFrame.  Nothing is executed until
the caller runs an action, apart from the few operators whose plan depends on a bounded
summary of the data (pivot headings, cluster counts); those say so.
"""

"""Message-stream analytics on Spark DataFrames.

Every operator takes and returns a DataFrame and works on batch and streaming input alike
unless its docstring says otherwise.
"""

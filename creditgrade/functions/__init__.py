"""Column expressions: no data is read or moved here.

Functions take column names and return a Column. They are written as SQL text,
which builds much faster from Python than a chain of Column calls.
"""

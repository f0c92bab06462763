"""Operators for large training-data pipelines.

One module per operator; ``queries`` holds the thin registered queries and
``oracle`` their DuckDB twins.  Nothing else in the library imports this
package.
"""

"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; removing the folder leaves the log
analytics engine intact.  Every operator takes and returns DataFrames.
"""

"""meterline: a PySpark library for urban trip records.

Every operator is a DataFrame -> DataFrame function (or a function that returns
a Column), so calls compose with ``df.transform`` and Catalyst sees one plan.
"""

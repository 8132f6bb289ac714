"""Operators of a training-data pipeline: duplicates, classifiers, audits, packing.

Each module holds one operator with an interface of its own; ``queries`` applies them to the
tables. Nothing outside this package imports it.

Common rules. Columns are named by parameters and other columns are ignored, so extra or
clashing names do no harm. A null text is an empty text unless the operator says otherwise.
Empty tables give empty results of the same schema.
"""

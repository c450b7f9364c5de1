"""Operations of a training-data pipeline.

Nothing else in the package imports this subpackage.  One module per
operator; ``queries`` registers the checked queries over the given tables.
"""

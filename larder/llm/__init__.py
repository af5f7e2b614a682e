"""Training-data operators: de-duplication, extraction, tokenising, quality, sharding.

Nothing else in the library imports this subpackage. Every operator is a
function over DataFrames with its column names as parameters; ``queries``
holds the registered queries and their SQL.
"""

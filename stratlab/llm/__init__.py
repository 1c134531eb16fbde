"""Training-data operators: ten dealt operators on documents, pages and conversations.

Nothing else in the library imports this subpackage. Operators take and
return DataFrames; ``queries`` holds the thin registered queries.
"""

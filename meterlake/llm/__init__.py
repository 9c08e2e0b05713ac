"""Training-data operators over document tables (ten operators and their queries).

Nothing else in the library imports this subpackage.
"""

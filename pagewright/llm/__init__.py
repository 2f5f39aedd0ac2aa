"""Operators for preparing training text: one module per problem.

Nothing outside this subpackage imports it; ``pagewright.llm.queries`` lists its
queries and their SQL.
"""

"""Training-data operators: ten text operators over ``documents`` and friends.

Nothing outside this package imports it; ``vitrina.llm.queries`` lists its queries.
"""

"""Scalar expressions: names, stamps, number text, anomaly rules, panel labels.

Each function takes SQL expression texts, usually column names, and returns one; use it with
`selectExpr`, `F.expr` or inside another.
"""

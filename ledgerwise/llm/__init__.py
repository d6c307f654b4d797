"""Operators for preparing training data at scale: one module per operator,
their registered queries in ``registry``. Nothing outside this subpackage
imports it."""

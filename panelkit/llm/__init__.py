"""Operators for preparing training text at scale.

Nothing outside this subpackage imports it. Each module holds one operator;
``queries`` registers one query per operator.
"""

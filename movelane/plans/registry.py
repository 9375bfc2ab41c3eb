"""Collects the queries of a module and their SQL."""

from __future__ import annotations


class Registry:
    def __init__(self):
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None):
        def add(function):
            self.queries[function.__name__] = function
            if sql:
                self.sql[function.__name__] = sql
            return function

        return add

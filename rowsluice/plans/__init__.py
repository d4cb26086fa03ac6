"""Loads over whole tables, and the registered queries."""


def _register() -> None:
    from rowsluice.plans import (  # noqa: F401
        catalog_queries,
        feed_queries,
        load_queries,
        validation_queries,
    )


def all_queries():
    from rowsluice.plans.registry import QUERIES

    _register()
    return dict(QUERIES)


def all_oracles():
    from rowsluice.plans.registry import ORACLES

    _register()
    return dict(ORACLES)

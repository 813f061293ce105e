"""Document queries on Spark: typed JSON filters, relationships, joins, versions and writes over collections."""

__all__ = ["Collection", "Engine", "Field", "Global", "Localization"]


def __getattr__(name: str):
    """The names above on first use, so that Python workers of other subpackages load nothing of the engine."""
    if name == "Engine":
        from .engine import Engine

        return Engine
    if name in __all__:
        from .plans import schema

        return getattr(schema, name)
    raise AttributeError(name)

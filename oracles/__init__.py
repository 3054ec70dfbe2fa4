"""DuckDB SQL equivalents of the registered queries (test side only)."""


def all_oracles() -> dict[str, str]:
    """SQL by query name."""
    from oracles import features, modelling, reports, star

    merged: dict[str, str] = {}
    for module in (star, features, modelling, reports):
        merged.update(module.ORACLES)
    return merged

"""Names for working columns beside columns of any name."""


def free(taken: list[str], *wanted: str) -> list[str]:
    """The wanted names, with underscores added where a column has them already, whatever its case."""
    used, out = {t.lower() for t in taken}, []
    for name in wanted:
        while name.lower() in used:
            name += "_"
        used.add(name.lower())
        out.append(name)
    return out

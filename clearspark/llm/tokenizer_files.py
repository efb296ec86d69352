"""Where the public vocabulary files are: a parameter, never part of the repository."""

import os


def vocabulary(name: str, folder: str | None = None) -> str:
    """The path of a vocabulary file in `folder`, by default the installed package's."""
    if folder is not None:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)

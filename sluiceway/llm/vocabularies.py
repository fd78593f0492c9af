"""Where the files of public tokenizers are."""

from __future__ import annotations

import os


def vocabulary(name: str) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))

"""Vocabulary files of public tokenizers (never trained or copied here)."""

from __future__ import annotations

import os


def file_bytes(name: str, folder: str | None = None) -> bytes:
    """A vocabulary file's content: from ``folder`` if one is given (a
    parameter of every operator that uses one), else from the installed package."""
    if folder:
        path = os.path.join(folder, name)
    else:
        import public_tokenizers

        path = public_tokenizers.path(name)
    with open(path, "rb") as f:
        return f.read()

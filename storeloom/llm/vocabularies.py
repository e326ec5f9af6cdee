"""Where the installed public tokenizer files are."""

from __future__ import annotations


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)

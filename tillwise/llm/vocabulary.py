"""Locating a tokenizer's vocabulary file. The files are public and stay where they are."""

import public_tokenizers

PIECE_MODEL = "piece_bpe_32k.model"


def vocabulary_path(name: str = PIECE_MODEL) -> str:
    return public_tokenizers.path(name)

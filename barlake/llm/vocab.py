"""Places of the public vocabulary files (never copied, never trained)."""
from __future__ import annotations

import os

PIECES = "piece_bpe_32k.model"
BYTES = "byte_bpe_50k.tiktoken"


def vocab_path(name: str, folder: str | None = None) -> str:
    """A file of ``folder``, or of the installed tokenizer package when no folder is given."""
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)

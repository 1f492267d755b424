"""Token ids of whole texts by a public vocabulary file."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from tokenizers import Tokenizer


class Encoder:
    """Encodes texts by a file for `tokenizers` (.json) or by the same vocabulary as ranks (.tiktoken), which is faster.

    Both give the same ids, those of special tokens that stand in a text included; the tests compare them. A text that
    the faster library refuses, such as a run of a million blanks, is encoded by the other file if it is given.
    """

    def __init__(self, path: str, special: dict[str, int] | None = None, fallback: str | None = None):
        self.path, self.plain, self.fast = path if path.endswith(".json") else fallback, None, None
        if not path.endswith(".json"):
            with open(path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special or {})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is not None:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except BaseException as refused:  # the library's own panics are no Exceptions
                if self.path is None or isinstance(refused, KeyboardInterrupt | SystemExit):
                    raise
        if self.plain is None:
            self.plain = Tokenizer.from_file(self.path)
        return np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text, in order."""
        for text in column:
            yield self.ids(text.as_py())


def byte_bpe_50k() -> Encoder:
    """The byte-level vocabulary of 50,257 ids."""
    return Encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), {"<|endoftext|>": 50256}, public_tokenizers.path("byte_bpe_50k.json"))

"""Document sizes in tokens of a public tokenizer."""

from __future__ import annotations

import os
from collections.abc import Iterator
from importlib.util import find_spec

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Folders that may hold the vocabulary files when no path is given.
VOCABULARY = "byte_bpe_50k.tiktoken"
#: The published pre-token pattern of the rank files.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Entries kept in a worker's table of counted words before it is emptied.
MEMO = 500_000


def vocabulary_path(path: str | None = None) -> str:
    """The rank file: the argument, else ``CORPUSMILL_TOKENIZER``, else the installed public vocabularies."""
    if path := path or os.environ.get("CORPUSMILL_TOKENIZER"):
        return path
    if spec := find_spec("public_tokenizers"):
        return os.path.join(os.path.dirname(spec.origin), VOCABULARY)
    return f"/opt/tokenizers/{VOCABULARY}"


class Counter:
    """Counts tokens of whole texts exactly, each distinct word once.

    Byte-pair merges never cross the pre-token pattern, and a pre-token starts at every space
    unless white space alone stands between two spaces or ends the text. So a text is the sum
    of its words, each with its leading space, and words repeat; a text with such a gap is
    encoded as a whole.
    """

    def __init__(self, path: str):
        import base64

        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encode = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        encode = self.encode

        class Memo(dict):
            def __missing__(self, word: str) -> int:
                if len(self) >= MEMO:
                    self.clear()
                n = self[word] = len(encode(" " + word)) if word.strip() else None
                return n

        self.memo = Memo()

    def __call__(self, text: str | None) -> int:
        if not text:
            return 0
        first, *rest = text.split(" ")
        try:
            return len(self.encode(first)) + sum(map(self.memo.__getitem__, rest))
        except TypeError:  # a word of white space alone
            return len(self.encode(text))


def count_tokens(text: Column | str, path: str | None = None) -> Column:
    """Tokens of each text; null and empty texts have 0. The worker loads the vocabulary once."""
    where = vocabulary_path(path)

    @F.pandas_udf("long")
    def counted(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        counter = Counter(where)
        for texts in batches:
            yield pd.Series([counter(t) for t in texts], dtype="int64")

    return counted(text)


def sized(documents: DataFrame, *, text: str = "text", keep: list[str], path: str | None = None, name: str = "n_tokens") -> DataFrame:
    """The kept columns and each document's size; the text itself goes no further than the scan's task."""
    return documents.select(*keep, count_tokens(F.col(text), path).alias(name))

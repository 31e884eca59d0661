"""Ids of texts by a tokenizer file, and back. The kind is told from the file's ending: ``.json`` or ``.model``.

A tokenizer is loaded once per Python worker. The file must be at the same path on all executors. Null texts give null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

Codec = tuple[Callable[[list[str]], list[list[int]]], Callable[[list[int]], str]]


@lru_cache(maxsize=8)
def codec(path: str, special: tuple[str, ...] = ()) -> Codec:
    """Batch encoder and decoder. ``special`` strings become single ids at the end of a ``.json`` vocabulary; no
    sentinels are added, as they are part of the text."""
    if path.endswith(".model"):
        import sentencepiece

        if special:
            raise ValueError("special tokens can be added to .json vocabularies only")
        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return (lambda texts: pieces.encode(texts, num_threads=1)), pieces.decode
    from tokenizers import AddedToken, Tokenizer

    t = Tokenizer.from_file(path)
    if special:
        t.add_special_tokens([AddedToken(s, normalized=False) for s in special])
    return (lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]), (lambda ids: t.decode(ids, skip_special_tokens=False))


def encode(text: Column, path: str, special: tuple[str, ...] = ()) -> Column:
    @F.pandas_udf("array<int>")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in parts:
            ids = codec(path, special)[0]([x or "" for x in t])
            yield pd.Series([None if x is None else i for x, i in zip(t, ids, strict=True)], index=t.index)

    return run(text)


def decode(ids: Column, path: str, special: tuple[str, ...] = ()) -> Column:
    @F.pandas_udf("string")
    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        back = codec(path, special)[1]
        for t in parts:
            yield t.map(lambda x: None if x is None else back([int(i) for i in x]))

    return run(ids)


def model_columns(ids: Column) -> list[Column]:
    """What a causal model reads: ids, token types of 0, a full mask, and labels, which are the ids."""
    return [ids.alias("input_ids"), F.transform(ids, lambda _: F.lit(0)).alias("token_type_ids"), F.transform(ids, lambda _: F.lit(1)).alias("attention_mask"), ids.alias("labels")]

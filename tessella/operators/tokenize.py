"""Token ids of a public tokenizer, cut to a length."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SLICE = 250_000


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer


def _slices(texts: pa.Array) -> Iterator[list[str]]:
    """The texts in runs of about ``SLICE`` characters, so that few encodings, many times their ids, are held at once."""
    part, size = [], 0
    for x in texts:
        part.append(x.as_py() or "")
        size += len(part[-1])
        if size >= SLICE:
            yield part
            part, size = [], 0
    if part:
        yield part


def truncated_ids(df: DataFrame, key: str, text: str, most: int, path: str = TOKENIZER) -> DataFrame:
    """``key, input_ids, n_ids``: at most ``most`` ids of each text, without padding; null and empty texts have none."""

    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            ids, sizes = [np.empty(0, np.int32)], []
            for part in _slices(texts):
                done = _tokenizer(path).encode_batch_fast(part, add_special_tokens=False)
                ids.extend(np.asarray(x.ids[:most], np.int32) for x in done)
                sizes.extend(min(len(x), most) for x in done)
            yield pa.ListArray.from_arrays(np.cumsum([0, *sizes], dtype=np.int32), np.concatenate(ids))

    return df.select(key, F.arrow_udf(encode, "array<int>")(F.col(text)).alias("input_ids")).withColumn("n_ids", F.size("input_ids"))

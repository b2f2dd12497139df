"""Byte-level BPE encoding and decoding with a local rank file."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import staged_map

#: A long text is cut where white space follows a character that is none. No match of the
#: pattern reaches over such a place, and no match to its left looks past it.
SAFE_CUT = re.compile(r"(?<=[A-Za-z0-9.,;:!?])(?=[ \n])")
LONG = 100_000


@lru_cache(maxsize=4)
def encoding(ranks: str, pattern: str):
    """The encoding of a rank file; one for each Python worker."""
    import tiktoken

    with open(ranks, "rb") as lines:
        table = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def pieces(text: str, size: int = LONG) -> Iterator[str]:
    """Parts of about ``size`` characters whose encodings, joined, are the encoding of ``text``.

    A stretch without a safe place stays whole.
    """
    start = 0
    while len(text) - start > size:
        cut = SAFE_CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


def encode(text: str, codec, size: int = LONG) -> np.ndarray:
    """Ids as unsigned 32-bit integers."""
    parts = [codec.encode_to_numpy(p, disallowed_special=()) for p in pieces(text, size)]
    return np.concatenate(parts).astype("<u4", copy=False) if len(parts) > 1 else parts[0].astype("<u4", copy=False)


def decode(ids: np.ndarray, codec, size: int = LONG) -> Iterator[bytes]:
    """The raw bytes, in parts; they need not be valid UTF-8 for ids from elsewhere."""
    for i in range(0, len(ids), size):
        yield codec.decode_bytes(ids[i : i + size].tolist())


def encode_documents(
    docs: DataFrame, ranks: str, pattern: str, keep_ids: bool = True, keep_text: bool = False, text: str = "text", size: int = LONG
) -> DataFrame:
    """Adds ``n_tokens``, ``ids_sha256``, ``decoded_sha256``, and with ``keep_ids`` the ids; the text goes unless ``keep_text``.

    ``ids`` is binary, little-endian unsigned 32-bit. A null text counts as empty: no
    ids, and the digests of nothing. Existing columns of these names are replaced; all
    other columns and repeated rows stay. The file of ranks must be at the same place on
    every machine. One pass over the rows without a shuffle, written to the shared folder.
    """
    spark = docs.sparkSession
    ship_package(spark)
    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} | ({"ids": "binary"} if keep_ids else {})
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    source = docs.drop(*added).withColumn("__text", F.coalesce(F.col(text), F.lit("")))
    source = source if keep_text else source.drop(text)

    def run(batches):
        codec = encoding(ranks, pattern)
        for batch in batches:
            out = {k: [] for k in added}
            for t in batch.column(batch.num_columns - 1):
                ids = encode(t.as_py(), codec, size)
                raw, back = ids.tobytes(), hashlib.sha256()
                for part in decode(ids, codec, size):
                    back.update(part)
                out["n_tokens"].append(len(ids))
                out["ids_sha256"].append(hashlib.sha256(raw).hexdigest())
                out["decoded_sha256"].append(back.hexdigest())
                if keep_ids:
                    out["ids"].append(raw)
            arrays = [*batch.columns[:-1], *(pa.array(out[k], kinds[v]) for k, v in added.items())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names[:-1], *added])

    schema = source.drop("__text").schema
    for name, kind in added.items():
        schema = schema.add(name, kind)
    return staged_map(source, run, schema, compression="zstd")

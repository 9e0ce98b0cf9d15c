"""Token counts by a public tokenizer."""

from __future__ import annotations

import base64
import os
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

FOLDER = os.environ.get("MILLRACE_TOKENIZERS", "/opt/tokenizers")
RANKS = "byte_bpe_50k.tiktoken"
# Fixed value: the pattern by which the vocabulary's texts were parted before merging.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def encoding(folder: str = FOLDER, ranks: str = RANKS):
    import tiktoken

    with open(os.path.join(folder, ranks), "rb") as f:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})


def _count(folder: str, ranks: str, terms: bool):
    def run(batches):
        enc = encoding(folder, ranks)
        for b in batches:
            n, ids, tfs = [], [], []
            for text in b.column(1).to_pylist():
                t = enc.encode_ordinary(text) if text else []
                n.append(len(t))
                if terms:
                    c = Counter(t)
                    ids.append(list(c.keys()))
                    tfs.append(list(c.values()))
            cols, names = [b.column(0), pa.array(n, pa.int64())], ["id", "n_tokens"]
            if terms:
                cols += [pa.array(ids, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int32()))]
                names += ["terms", "tfs"]
            yield pa.RecordBatch.from_arrays(cols, names)

    return run


def token_counts(docs: DataFrame, terms: bool = False, folder: str = FOLDER, ranks: str = RANKS) -> DataFrame:
    """docs (id long, text) -> (id, n_tokens) over whole texts, with ``terms`` also the distinct tokens and their counts. Null text: 0."""
    schema = "id long, n_tokens long" + (", terms array<int>, tfs array<int>" if terms else "")
    return docs.select("id", "text").mapInArrow(_count(folder, ranks, terms), schema)

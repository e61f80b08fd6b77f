"""BPE encoding and decoding of whole tables.

Each row is handled alone; a task holds one slice of text and a bounded memo of pieces, so
neither long texts nor hot sources matter, and a lost executor costs a rerun of its tasks.

Defined results: null text is the empty text (no ids); an empty table gives an empty result;
repeated rows and null ids are rows like any other; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from avspark.llm.common import slices, texts

_coders: dict[tuple[str, str], tuple] = {}


def _coder(path: str, pattern: str):
    from avspark.llm.bpe import ByteBpe
    from avspark.llm.pieces import Pieces, flat

    if (path, pattern) not in _coders:
        bpe = ByteBpe(path, pattern)
        _coders[path, pattern] = bpe, Pieces(lambda keys: flat(bpe.encode_all(keys)), keeps_space=True)
    return _coders[path, pattern]


def encoded(docs: DataFrame, path: str, pattern: str, digests: bool = False) -> DataFrame:
    """doc_id, ids (array<int>), decoded (binary); with ``digests`` doc_id, n_tokens and
    SHA-256 of the ids (little-endian, 32 bits) and of the decoded bytes instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, pieces = _coder(path, pattern)
        for batch in slices(batches):
            ids, counts = pieces(batch.column("text"))
            plain, sizes = bpe.decode(ids)
            cuts = np.concatenate([[0], np.cumsum(counts)])
            byte_cuts = np.concatenate([[0], np.cumsum(sizes)])[cuts]
            if digests:
                raw, text = memoryview(ids.astype("<u4").tobytes()), memoryview(plain.tobytes())
                sha = lambda x, a, b: hashlib.sha256(x[a:b]).hexdigest()
                more = [
                    pa.array(counts),
                    pa.array([sha(raw, 4 * a, 4 * b) for a, b in zip(cuts, cuts[1:], strict=False)], pa.string()),
                    pa.array([sha(text, a, b) for a, b in zip(byte_cuts, byte_cuts[1:], strict=False)], pa.string()),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            else:
                more = [
                    pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(ids.astype(np.int32))),
                    pa.array([plain[a:b].tobytes() for a, b in zip(byte_cuts, byte_cuts[1:], strict=False)], pa.binary()),
                ]
                names = ["doc_id", "ids", "decoded"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *more], names)

    schema = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" if digests
              else "doc_id long, ids array<int>, decoded binary")
    return texts(docs).mapInArrow(run, schema)

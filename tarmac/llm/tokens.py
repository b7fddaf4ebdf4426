"""Token ids of whole texts by a public byte-level BPE vocabulary.

The vocabulary file is a parameter (a rank file, one ``base64 rank`` pair a
line); the default has the same vocabulary and split pattern as
``byte_bpe_50k.json`` and gives the same ids (tests compare both libraries).
Strings of special tokens inside a text are ordinary text."""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.base import source_key

VOCABULARY = "byte_bpe_50k.tiktoken"
EOS = 1
_cached: dict = {}


def encoder(path: str | None = None):
    """One encoder per worker process and file."""
    if path not in _cached:
        import public_tokenizers
        import tiktoken
        with open(path or public_tokenizers.path(VOCABULARY), "rb") as f:
            ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, f)}
        _cached[path] = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})
    return _cached[path]


def token_ids(text: str | None, enc) -> np.ndarray:
    """Ids of one text (null: none) as uint32, then the end id."""
    ids = enc.encode_to_numpy(text) if text else ()
    out = np.empty(len(ids) + 1, np.uint32)
    out[:-1] = ids
    out[-1] = EOS
    return out


#: rows leave a task in batches of about so many ids
BATCH_IDS = 1 << 20


def tokenise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str | None = "source",
             vocabulary: str | None = None, unit: int = 1) -> DataFrame:
    """``uid, part, doc, src, n, pos, ids``: one row per input row.

    ``ids`` are little-endian uint16 (uint32 where the vocabulary needs it), end
    id included; ``part`` is the scan task, ``uid`` is unique, ``pos`` counts the
    tokens (in ``unit`` tokens, rounded up per row) of the same source before the
    row in its task, so positions in a source's stream need only the totals per
    (task, source) - no sort and no window over documents. Write the result before using it twice."""

    def work(batches):
        enc = encoder(vocabulary)
        kind = "<u4" if enc.max_token_value >= 1 << 16 else "<u2"
        part = TaskContext.get().partitionId()
        seq, before = 0, {}
        cols: list[list] = [[] for _ in range(7)]
        held = 0

        def flush():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(),
                                                       pa.int64(), pa.binary()))],
                ["uid", "part", "doc", "src", "n", "pos", "ids"])

        for b in batches:
            for doc, text, src in zip(b.column(0).to_pylist(), b.column(1), b.column(2).to_pylist()):
                ids = token_ids(text.as_py(), enc)
                n = len(ids)
                pos = before.get(src, 0)
                before[src] = pos - (-n // unit)
                for c, v in zip(cols, ((part << 33) | seq, part, doc, src, n, pos, ids.astype(kind).tobytes())):
                    c.append(v)
                seq += 1
                held += n
                if held >= BATCH_IDS:
                    yield flush()
                    cols, held = [[] for _ in range(7)], 0
        if cols[0]:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).cast("string").alias("text"),
                       (source_key(source_col) if source_col else F.lit("")).alias("src"))
    return rows.mapInArrow(work, "uid long, part long, doc long, src string, n long, pos long, ids binary")

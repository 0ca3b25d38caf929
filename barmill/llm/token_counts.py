"""Token counts of whole texts: batch encoding in Arrow functions that return lengths only.

Texts of byte-level files are cut at every safe border and each distinct piece is encoded once. Texts for other files go
to the tokenizer whole, in batches balanced by bytes; long ones are first cut where the file's tokens never span a blank.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barmill.llm import library
from barmill.llm.chunks import sums
from barmill.llm.common import byte_slices, text_rows

#: Bytes of text in one call to the tokenizer, and of a piece that a long text is cut into.
BATCH_BYTES = 1 << 20
#: A blank between two ASCII letters or digits: no normaliser changes it or them together.
_BORDER = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str) -> tuple[Callable, bool]:
    """(token counts of texts, whether a long text may be cut at a _BORDER, the blank left out); read once for each worker."""
    if path.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        inner = any("▁" in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size()))
        apart = model.encode("a b", out_type=str) == model.encode("a", out_type=str) + model.encode("b", out_type=str)
        return lambda texts: list(map(len, model.encode(texts, num_threads=1))), apart and not inner
    own = library.tokenizer(path)
    pieces = own.pre_tokenizer.pre_tokenize_str("a b") if own.pre_tokenizer else []
    apart = own.normalizer is None or own.normalizer.normalize_str("a b").lower() == "a b"
    special = any(any(c.isspace() for c in t["content"]) or t["lstrip"] or t["rstrip"] for t in library.spec_of(path)["added_tokens"])
    return lambda texts: list(map(len, own.encode_batch_fast(texts, add_special_tokens=False))), apart and not special and [p for p, _ in pieces] == ["a", "b"]


def pieces(text: str, most: int = BATCH_BYTES) -> list[str]:
    """A text cut at the first _BORDER behind each `most` characters."""
    out, a = [], 0
    while len(text) - a > most:
        cut = _BORDER.search(text, a + most)
        if cut is None:
            break
        out.append(text[a : cut.start()])
        a = cut.end()
    return [*out, text[a:]]


def _counted(count: Callable, texts: list[str]) -> np.ndarray:
    """Calls the tokenizer on runs of texts of about BATCH_BYTES bytes."""
    sizes = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
    part = np.cumsum(sizes) // BATCH_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(texts)]
    out: list[int] = []
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            out += count(texts[a:b])
    return np.asarray(out, dtype=np.int64)


@functools.lru_cache(maxsize=2)
def _cut_by_chunks(path: str) -> bool:
    return not path.endswith(".model") and library.has_safe_borders(library.spec_of(path))


def column_counts(path: str, column: pa.Array) -> np.ndarray:
    """Token count of each text of a column; a chunk that occurs again is encoded once."""
    if _cut_by_chunks(path):
        return library.load(path).count_column(column)
    count, apart = _tokenizer(path)
    each = [pieces(t) if apart else [t] for t in column.to_pylist()]
    return sums(_counted(count, [x for own in each for x in own]), np.fromiter(map(len, each), np.int64, len(each)))


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row; over_limit: more than `limit` tokens.

    A null text counts as empty: no bytes, no tokens. Rows are counted one by one, also repeated ones. An empty table
    gives an empty one; further columns are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in byte_slices(batch):
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(column_counts(tokenizer, part.column(1)))], names=["doc_id", "n_bytes", "n_tokens"])

    rows = text_rows(docs, id_col, text_col).withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)

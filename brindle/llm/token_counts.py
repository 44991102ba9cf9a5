"""Token counts of whole texts."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from brindle.llm.texts import slices

_SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
_MARK = "▁"


@functools.lru_cache(maxsize=2)
def load_pieces(path: str):
    """The vocabulary, and whether a text may be cut before a space that follows another character.

    It may if no piece goes on with a space after another character: then no merge crosses the cut,
    and the space is what the library puts before every text.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = (model.id_to_piece(i) for i in range(model.get_piece_size()))
    separable = not any(_MARK in piece.lstrip(_MARK) for piece in pieces)
    return model, separable and model.encode("a b") == [*model.encode("a"), *model.encode("b")]


def safe_parts(text: str, most: int) -> list[str]:
    """Parts of about `most` characters whose token counts add up to that of the text."""
    parts, begin = [], 0
    while len(text) - begin > most:
        cut = text.find(" ", begin + most)
        while cut > 0 and text[cut - 1] in (" ", _MARK):  # the library takes the mark for a space
            cut = text.find(" ", cut + 1)
        if cut < 0 or cut + 1 >= len(text):
            break
        parts.append(text[begin:cut])
        begin = cut + 1
    parts.append(text[begin:])
    return parts


def count_tokens(docs: DataFrame, model_path: str, limit: int = 4096, part_chars: int = 1 << 16) -> DataFrame:
    """`doc_id, n_bytes, n_tokens, over_limit` for every row of `docs(doc_id, text, ...)`.

    Tokens are those of the sentencepiece library without begin and end tokens. Only lengths leave
    the tasks. Texts are encoded in batches of equal bytes, and a text longer than `part_chars` is
    cut at safe boundaries into parts that are counted on their own. A null or empty text has no
    bytes and no tokens; repeated rows and rows without id give a row each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, separable = load_pieces(model_path)
        for texts in slices(batches):
            parts, owner = [], []
            for i, text in enumerate(texts.rows.column("text").to_pylist()):
                own = safe_parts(text or "", part_chars) if separable else [text or ""]
                parts += own
                owner += [i] * len(own)
            lengths = [len(ids) for ids in model.encode(parts, num_threads=1)]
            counts = np.bincount(owner, weights=lengths, minlength=len(texts.rows)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    texts.rows.column("doc_id"),
                    pa.array(np.diff(texts.offsets)),
                    pa.array(counts),
                    pa.array(counts > limit),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(run, _SCHEMA)
